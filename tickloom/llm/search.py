"""Ranked lexical search in reverse: the documents stream past an inverted index of the items.

The items' distinct texts are queries. Their terms form an inverted index, which is small and broadcast; a set of
items whose texts exceed a bound is searched in blocks. Every document's term counts pass the index once: a term's
postings say which queries it adds to. A task keeps, for every query, a heap of the best documents it has seen, never
more than asked for, and the heaps of all tasks are merged.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from tickloom.llm.common import SLICE_BYTES, col, slices
from tickloom.session import written

# Fixed values of the score.
SCALE, LENGTH_SHARE, LENGTH_WEIGHT, GAIN = 1000, 25, 12, 1_000_000_000
# Bytes of item texts in one broadcast index, and cells of a block of scores.
INDEX_BYTES, CELLS = 4 << 20, 1 << 20
# ASCII letters in lower case, digits and all that is not ASCII stay; the rest parts terms.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, those of a very long one in several lists."""
    at = 0
    while len(text) - at > 2 * SLICE_BYTES:
        part = text[at : at + SLICE_BYTES].translate(_FOLD)
        cut = part.rfind(b" ") + 1
        if not cut:  # one term goes on beyond: to its end
            rest = text[at:].translate(_FOLD)
            cut = rest.find(b" ") + 1 or len(rest)
            part = rest[:cut]
        yield part[:cut].split(b" ")
        at += cut
    yield text[at:].translate(_FOLD).split(b" ")


def term_counts(text: bytes) -> Counter:
    found: Counter = Counter()
    for some in terms(text):
        found.update(some)
    found.pop(b"", None)
    return found


class Index:
    """The inverted index of some queries: which queries a term adds to, and how often it stands in each."""

    def __init__(self, queries: list[tuple[int, str]]) -> None:
        counted = [(number, term_counts(text.encode("utf-8", "replace"))) for number, text in queries]
        self.numbers = np.array([n for n, _ in counted], np.int64)
        self.terms = {t: k for k, t in enumerate(sorted({t for _, c in counted for t in c}))}
        found = sorted((self.terms[t], q, n) for q, (_, c) in enumerate(counted) for t, n in c.items())
        term, self.query, self.times = (np.array([x[k] for x in found], np.int64) for k in range(3))
        self.first = np.searchsorted(term, np.arange(len(self.terms) + 1))


class _Place:
    """A document in a heap whose top is the worst: the lower score, then the higher id; null is the highest."""

    __slots__ = ("doc", "score")

    def __init__(self, score: int, doc) -> None:
        self.score, self.doc = score, doc

    def __lt__(self, other: _Place) -> bool:
        if self.score != other.score:
            return self.score < other.score
        if self.doc is None or other.doc is None:
            return self.doc is None and other.doc is not None
        return self.doc > other.doc


def _counted(docs: DataFrame, index, id_col: str, text_col: str) -> DataFrame:
    """Documents with at least one term: doc_id, their number of terms, the index's terms in them and their counts."""
    rows = docs.select(col(docs, id_col).alias("doc_id"), col(docs, text_col).alias("text")).filter(F.col("text") != "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value.terms
        for batch in slices(batches, 1):
            total, ends, where, times = [], [0], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                found = term_counts(text)
                total.append(found.total())
                for term, n in found.items():
                    if term in known:
                        where.append(known[term])
                        times.append(n)
                ends.append(len(where))
            offsets = pa.array(ends, pa.int32())
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(where, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))], names=["doc_id", "n", "terms", "times"])
            yield out.filter(pa.array(np.array(total) > 0))

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, times array<long>")


def _best(counted: DataFrame, index, weights: np.ndarray, docs: int, length: int, k: int) -> DataFrame:
    """The best ``k`` documents of every query in each task: query, doc_id, score."""
    kind = counted.schema["doc_id"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        width, heaps = len(known.numbers), [[] for _ in known.numbers]
        bar = np.ones(width, np.int64)  # a document must reach this to enter a query's heap
        step, most = 32, max(32, CELLS // max(1, width))
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                some = batch.slice(at, step)
                at += some.num_rows
                scores = _scores(some, known, weights, docs, length)
                row, query = np.nonzero(scores >= bar)
                if len(row):
                    ids = some.column(0).take(pa.array(row)).to_pylist()
                    for doc, q, score in zip(ids, query.tolist(), scores[row, query].tolist()):
                        place = _Place(score, doc)
                        if len(heaps[q]) < k:
                            heapq.heappush(heaps[q], place)
                        elif heaps[q][0] < place:
                            heapq.heapreplace(heaps[q], place)
                    bar = np.array([h[0].score if len(h) == k else 1 for h in heaps], np.int64)
                # few documents first, so that the bars stand before most are looked at
                step = min(2 * step, most)
        told = [(int(known.numbers[q]), p.doc, p.score) for q, h in enumerate(heaps) for p in h]
        if told:
            number, doc, score = zip(*told)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), pa.array(doc, counted_type), pa.array(score, pa.int64())],
                names=["query", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    counted_type = to_arrow_type(kind)
    return counted.mapInArrow(run, f"query long, doc_id {kind.simpleString()}, score long")


def _scores(batch: pa.RecordBatch, index: Index, weights: np.ndarray, docs: int, length: int) -> np.ndarray:
    """The score of every document of a batch for every query."""
    n = batch.column(1).to_numpy()
    lists = batch.column(2)
    counts = np.diff(lists.offsets.to_numpy())
    term, times = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy()
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * docs) // length
    value = weights[term] * ((GAIN * times) // (SCALE * times + LENGTH_WEIGHT * np.repeat(m, counts)))
    scores = np.zeros((batch.num_rows, len(index.numbers)), np.int64)
    if not len(term):
        return scores
    # each term's postings, one after the other; a part of them at a time
    owner = np.repeat(np.arange(batch.num_rows), counts)
    posted = index.first[term + 1] - index.first[term]
    marks = np.cumsum(posted)
    at = 0
    while at < len(term):
        to = max(at + 1, int(np.searchsorted(marks, (marks[at - 1] if at else 0) + CELLS, side="right")))
        p, sizes = np.arange(posted[at:to].sum()), posted[at:to]
        p += np.repeat(index.first[term[at:to]] - (np.cumsum(sizes) - sizes), sizes)
        np.add.at(scores, (np.repeat(owner[at:to], sizes), index.query[p]), np.repeat(value[at:to], sizes) * index.times[p])
        at = to
    return scores


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for every item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. With N the
    documents that have a term, L all their terms, df those that hold a term, a term's weight is
    ``floor(1000 ln((2N+2)/(2df+1)))``; a document of n terms in which it stands tf times adds
    ``weight * (10^9 tf div (1000 tf + 12 m))``, with ``m = 75 + 25 n N div L``, for each time the term stands in the item.

    Equal scores are ranked by ascending id, null ids last. Rows that repeat an id are documents of their own, and rows
    of items queries of their own, also where they are equal; equal texts of items are searched once. Null and empty
    texts have no terms and occur in no row; an empty table gives no rows; other columns are not read. All texts are
    read whole, a very long one in parts. Counts are kept in the shared folder, only those of terms that items have.

    An index is broadcast for items of up to ``index_bytes`` of distinct text, or one longer item; more items are
    searched in blocks, each of which reads the documents once.
    """
    spark = docs.sparkSession
    asked = items.select(col(items, item_col).alias("item_id"), col(items, item_text_col).alias("text")).filter(F.col("text") != "")
    texts = written(asked.select("text").distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = -(-size // index_bytes)
    found = []
    for block in range(blocks):
        some = texts.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)
        # bounded by index_bytes or by one row, as blocks are counted from the texts' size
        index = spark.sparkContext.broadcast(Index([(r["query"], r["text"]) for r in some.toLocalIterator()]))
        if not index.value.terms:
            continue
        counted = written(_counted(docs, index, id_col, text_col), "term-counts")
        n, length = counted.agg(F.count("*"), F.sum("n")).first()
        if not n:
            continue
        holding = np.zeros(len(index.value.terms), np.int64)
        for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holding[r["term"]] = r["count"]
        weights = np.array([math.floor(SCALE * math.log((2 * n + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)
        found.append(_best(counted, index, weights, n, length, k))
    kind = docs.select(col(docs, id_col)).schema[0].dataType.simpleString()
    if not found:
        best = spark.createDataFrame([], f"query long, doc_id {kind}, score long")
    else:
        best = found[0]
        for more in found[1:]:
            best = best.unionByName(more)
    # at most k rows of a query from each task
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return asked.join(texts, "text").join(ranked, "query").select("item_id", "rank", "doc_id", "score")
