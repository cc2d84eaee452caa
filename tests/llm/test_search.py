import math
import re
from collections import Counter

import pytest

from tickloom.llm import search
from tickloom.llm.common import SLICE_BYTES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plainly(docs, items, k):
    """The rows of the definition: every item against every document."""
    counted = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    n_docs, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in counted:
            m = 75 + 25 * n * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in TERM.findall(lower(text)) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, k=3, **more):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string").repartition(3)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    return sorted(map(tuple, search.search(d, q, k, **more).collect()), key=str)


DOCS = [
    (1, "Red red fox"), (2, "red; FOX jumps"), (3, "blue fox"), (4, None), (5, ""), (6, "... --- !"), (7, "Éclair éclair 12a"),
    (2, "red; FOX jumps"), (None, "red fox red fox"), (None, "blue"), (9, "red " * 500), (10, "KK k İ"), (11, "red fox"), (8, "red fox"),
]
ITEMS = [(1, "RED fox"), (1, "RED fox"), (2, None), (3, ""), (None, "fox fox blue"), (4, "Éclair"), (5, "éclair 12A"), (6, "k"), (7, "nowhere")]


@pytest.mark.parametrize("size", [search.INDEX_BYTES, 8])
def test_ranks_against_the_definition_with_ties_nulls_and_repeats(spark, size):
    """The small bound deals the items into blocks, each searched on its own."""
    assert ranked(spark, DOCS, ITEMS, index_bytes=size) == plainly(DOCS, ITEMS, 3)


def test_heaps_stay_bounded_and_right_over_many_documents(spark):
    docs = [(k, " ".join(["fox"] * (k % 7) + ["red"] * (k % 5) + ["w%d" % (k % 90)] * 3)) for k in range(3000)]
    items = [(k, f"red fox w{k}") for k in range(5)]
    assert ranked(spark, docs, items, k=20) == plainly(docs, items, 20)


def test_empty_tables(spark):
    assert ranked(spark, [], ITEMS) == [] and ranked(spark, DOCS, []) == []
    assert ranked(spark, [(1, None)], ITEMS) == [] and ranked(spark, DOCS, [(1, "!"), (2, None)]) == []


def test_very_long_texts_are_counted_in_parts():
    text = ("Red fox, " * (SLICE_BYTES // 4)).encode()
    assert len(list(search.terms(text))) > 1
    assert search.term_counts(text) == {b"red": SLICE_BYTES // 4, b"fox": SLICE_BYTES // 4}
    unbroken = b"a" * (3 * SLICE_BYTES) + b" b"
    assert search.term_counts(unbroken) == {b"a" * (3 * SLICE_BYTES): 1, b"b": 1}


def test_ids_of_texts(spark):
    d = spark.createDataFrame([("b", "red"), ("a", "red"), (None, "red"), ("c", "blue")], "doc_id string, text string")
    q = spark.createDataFrame([("q", "red")], "item_id string, text string")
    got = sorted(map(tuple, search.search(d, q, 2).select("item_id", "rank", "doc_id").collect()))
    assert got == [("q", 1, "a"), ("q", 2, "b")]
