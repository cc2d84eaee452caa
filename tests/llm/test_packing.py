import numpy as np
import pytest

from tickloom.llm import packing, tokens

PATH = tokens.public_tokenizer("word_bpe_49k.json")


def test_differencing_is_near_equal():
    rng = np.random.default_rng(0)
    for k in (1, 2, 3, 7):
        for n in (0, 1, 2, 5, 60):
            sizes = rng.integers(1, 100, n)
            parts = packing.differencing(sizes, k)
            assert sorted(i for p in parts for i in p) == list(range(n)) and len(parts) <= k
            if n == 60:
                sums = [sizes[p].sum() for p in parts]
                assert max(sums) - min(sums) <= 5 and len(parts) == k
    # the textbook case: 8, 7, 6, 5, 4 in two parts differ by 2 under differencing
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in p) for p in packing.differencing(np.array([8, 7, 6, 5, 4]), 2))
    assert sums == [14, 16]


def test_windows_rise_until_all_fit():
    assert len(packing.pack_sizes(np.array([3, 3, 3]), 4)) == 3
    rng = np.random.default_rng(1)
    for _ in range(50):
        sizes = rng.integers(1, 41, rng.integers(1, 80))
        windows = packing.pack_sizes(sizes, 40)
        assert max(sizes[w].sum() for w in windows) <= 40
        assert sorted(i for w in windows for i in w) == list(range(len(sizes)))


def check(docs, pieces, capacity):
    tool = tokens.Encoder(PATH).tokenizer
    want = sorted((str(i), tuple(tool.encode(t or "", add_special_tokens=False).ids + [2])) for i, t, *_ in docs)
    whole, sequences = {}, {}
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        whole.setdefault((r.document, r.doc_id, r.doc_tokens), []).append((r.start, ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    got = []
    for (_, doc_id, total), parts in whole.items():
        parts.sort()
        assert [s for s, _ in parts] == [int(x) for x in np.cumsum([0] + [len(p) for _, p in parts])[:-1]]
        ids = [i for _, p in parts for i in p]
        assert len(ids) == total
        got.append((str(doc_id), tuple(ids)))
    assert sorted(got) == want
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [int(x) for x in np.cumsum([0] + [n for _, n in parts])[:-1]]
        assert sum(n for _, n in parts) <= capacity
    return len(sequences)


@pytest.mark.parametrize(("capacity", "piece"), [(64, 16), (64, 64), (4096, 512)])
def test_every_id_lies_in_one_piece(spark, capacity, piece):
    docs = [(k, "word " * (k * 13 % 90), "s") for k in range(150)] + [(None, None, "s"), (3, "", "s"), (3, "", "s"), (9, "long text " * 5000, "s")]
    df = spark.createDataFrame(docs, "doc_id long, text string, start string").repartition(3)
    pieces = packing.pack(df, PATH, capacity=capacity, piece=piece, windows=20).collect()
    assert check(docs, pieces, capacity) > 3


def test_little_padding(small_documents):
    rows = [tuple(r) for r in small_documents.select("doc_id", "text").collect()]
    pieces = packing.pack(small_documents, PATH).collect()
    sequences = check(rows, pieces, 4096)
    assert sum(p.length for p in pieces) / (4096 * sequences) > 0.97
    again = packing.pack(small_documents, PATH).collect()
    assert again == pieces


def test_no_documents(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
