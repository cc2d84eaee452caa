"""Packing documents into sequences of equal length by multiway differencing.

A task packs its documents in groups of about ``windows`` sequences. A piece is at most one sequence
long. The pieces of a group are partial partitions of ``k`` windows each, one window filled. Again and
again the two partial partitions with the largest difference between their fullest and emptiest window
are merged, the fullest windows of one with the emptiest of the other, until one partition is left. ``k``
starts at the least that can hold the group and rises while a window exceeds the capacity.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tickloom.llm.common import col, slices
from tickloom.llm.records import TOKEN_SLICE
from tickloom.llm.tokens import encoder

PIECES = "sequence_id long, offset long, length long, doc_id long, document long, start long, doc_tokens long, ids binary"
_SCHEMA = pa.schema([(n, pa.int64()) for n in (
    "sequence_id", "offset", "length", "doc_id", "document", "start", "doc_tokens")] + [("ids", pa.binary())])
# Sequences of a task are numbered from here times the partition's number.
TASK_STEP = 1 << 33


def differencing(sizes: np.ndarray, k: int) -> list[list[int]]:
    """The pieces (by place in ``sizes``) of each of ``k`` windows with nearly equal sums.

    Ties are taken in the order the pieces come, so equal input gives equal output.
    """
    # a partial partition: (-difference, order, sums ascending, pieces); windows beyond the list are empty
    heap = [(-int(s), i, [int(s)], [[i]]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        _, _, sums_a, parts_a = heapq.heappop(heap)
        _, _, sums_b, parts_b = heapq.heappop(heap)
        if len(sums_a) < len(sums_b):
            sums_a, parts_a, sums_b, parts_b = sums_b, parts_b, sums_a, parts_a
        # opposing order: the fullest of b meet the emptiest of a, empty windows first
        empty = k - len(sums_a)
        sums, parts = list(sums_a), list(parts_a)
        for j, (s, p) in enumerate(zip(reversed(sums_b), reversed(parts_b))):
            if j < empty:
                sums.append(s)
                parts.append(p)
            else:
                sums[j - empty] += s
                parts[j - empty] = parts[j - empty] + p
        by = sorted(range(len(sums)), key=sums.__getitem__)
        sums, parts = [sums[i] for i in by], [parts[i] for i in by]
        difference = sums[-1] - (sums[0] if len(sums) == k else 0)
        heapq.heappush(heap, (-difference, order, sums, parts))
        order += 1
    return heap[0][3] if heap else []


def pack_sizes(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity`` each; their number rises until the differencing fits."""
    if not len(sizes):
        return []
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        windows = differencing(sizes, k)
        if max(int(sizes[w].sum()) for w in windows) <= capacity:
            return windows
        k += max(1, k // 128)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, piece: int = 512,
    windows: int = 256, id_col: str = "doc_id", text_col: str = "text", forget: bool = False,
) -> DataFrame:
    """The pieces of all documents with their place in the sequences: one row per piece.

    A document's tokens, end id included, are cut into whole sequences and a rest; the rest is cut into
    pieces of at most ``piece`` tokens, which lets windows come out nearly equal, and packed within a group
    of about ``windows`` sequences. Pieces of one document that stand side by side in a sequence are joined
    again. Each task works on its own partition in one pass, without a shuffle, and holds one group of
    tokens, or one document if that is longer.

    Result: sequence_id (unique, ascending by partition), offset (gapless from 0 in a sequence), length,
    doc_id, document (unique number of the row), start (tokens of the document before), doc_tokens, ids
    (little-endian unsigned 32-bit). A null or empty text is the end id alone; null and repeated ids are
    packed like any other; an empty table gives no rows; other columns are not read. With ``forget`` a worker drops
    the words it knows when a partition ends, so that it holds little while other work runs.
    """
    rows = docs.select(col(docs, id_col).cast("long").alias("doc_id"), col(docs, text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, base = encoder(tokenizer), TaskContext.get().partitionId() * TASK_STEP
        sequence, document, group, held = base, base, [], 0
        for batch in slices(batches, 1, TOKEN_SLICE):
            counts, flat = tool.encode(batch.column(1))
            marks = np.concatenate([[0], np.cumsum(counts)])
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                ids = np.append(flat[marks[k] : marks[k + 1]], np.uint32(end_id)).astype("<u4")
                group.append((doc_id, document, ids))
                document += 1
                held += len(ids)
                if held >= windows * capacity:
                    out, sequence = _group(group, capacity, piece, sequence)
                    yield out
                    group, held = [], 0
        if group:
            yield _group(group, capacity, piece, sequence)[0]
        if forget:
            tool.forget()

    return rows.mapInArrow(run, PIECES)


def _group(group: list, capacity: int, piece: int, sequence: int) -> tuple[pa.RecordBatch, int]:
    """The rows of one group's pieces, and the next free sequence number."""
    rows, rests = [], []
    for doc_id, document, ids in group:
        whole = len(ids) // capacity * capacity
        for start in range(0, whole, capacity):
            rows.append((sequence, 0, capacity, doc_id, document, start, len(ids), ids[start : start + capacity].tobytes()))
            sequence += 1
        for start in range(whole, len(ids), piece):
            rests.append((doc_id, document, ids, start, min(start + piece, len(ids))))
    for window in pack_sizes(np.array([r[4] - r[3] for r in rests], np.int64), capacity):
        offset, parts = 0, []
        for k in sorted(window):  # by document and start: neighbours are joined
            doc_id, document, ids, start, end = rests[k]
            if parts and parts[-1][1] == document and parts[-1][4] == start:
                parts[-1][4] = end
            else:
                parts.append([doc_id, document, ids, start, end])
        for doc_id, document, ids, start, end in parts:
            rows.append((sequence, offset, end - start, doc_id, document, start, len(ids), ids[start:end].tobytes()))
            offset += end - start
        sequence += 1
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA), sequence
