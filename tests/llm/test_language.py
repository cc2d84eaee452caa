import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import language


def test_gradients():
    rng = np.random.default_rng(0)
    f64 = lambda *s: rng.normal(0, 0.5, s)
    h = 3
    make = lambda: language.Direction(f64(256, 3 * h), f64(h, 2 * h), f64(h, h))
    model = language.Model(make(), make(), f64(2 * h, 2), f64(2), ["a", "b"])
    codes, y = rng.integers(97, 100, (5, 4)).astype(np.uint8), np.array([0, 1, 1, 0])

    def loss():
        p, _ = model.labels(codes)
        return -np.log(p[:, np.arange(4), y]).sum()

    keep = ({}, {})
    p, states = model.labels(codes, keep)
    d = p.copy()
    d[:, np.arange(4), y] -= 1
    above = (d.reshape(-1, 2) @ model.out.T).reshape(states.shape)
    got = [*model.forwards.back(range(5), codes, keep[0], above[:, :, :h]),
           *model.backwards.back(reversed(range(5)), codes, keep[1], above[:, :, h:])]
    for p, g in zip(model.parameters(), got):
        for at in zip(*[rng.integers(0 if n < 200 else 97, min(n, 100), 6) for n in p.shape]):
            before, step = p[at], 1e-2
            p[at] = before + step
            up = loss()
            p[at] = before - step
            down = loss()
            p[at] = before
            assert abs((up - down) / (2 * step) - g[at]) < 0.02 * max(1, abs(g[at]))


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(corpus):
    return language.fit(corpus.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))


def test_held_out_accuracy(corpus, model):
    held = corpus.filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    found = language.with_language(held, model).select("lang", "language.*").collect()
    right = sum(r.lang == r.lang_pred for r in found) / len(found)
    assert len(found) > 250 and right >= 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_a_text_is_read_alone_and_whole(model):
    texts = [b"the end of the story", b"x" * 1000 + "und die Geschichte der ".encode() * 50, b"", b"la fin" * 77]
    together = model.probabilities(texts)
    for t, p in zip(texts, together):
        assert np.allclose(model.probabilities([t])[0], p, atol=1e-5)
    assert np.allclose(together.sum(axis=1), [1, 1, 0, 1], atol=1e-4)
    # the mean of the labels of all windows, computed one window at a time
    parts = [texts[1][k : k + model.span] for k in range(0, len(texts[1]), model.span)]
    means = sum(model.probabilities([p])[0] * len(p) for p in parts) / len(texts[1])
    assert np.allclose(means, together[1], atol=1e-5)


def test_texts_without_letters(spark, model):
    rows = [(1, None, "a"), (2, "", "b"), (3, "12 34 !?", "c"), (4, "der Hund und die Katze", "d"), (4, "der Hund und die Katze", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, predicted string")
    got = language.with_language(docs, model).orderBy("doc_id").collect()
    assert [r.language.lang_pred for r in got][:3] == ["und"] * 3 and [r.language.score for r in got][:3] == [0] * 3
    assert got[3].language == got[4].language and got[3].language.lang_pred in model.languages
    assert language.with_language(docs, model).columns == ["doc_id", "text", "predicted", "language"]
    assert language.with_language(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, "12", "en")], "doc_id long, text string, lang string")
    assert language.fit(docs) is None
    assert [r.language.lang_pred for r in language.with_language(docs, None).collect()] == ["und", "und"]


def test_the_same_input_gives_the_same_model(corpus):
    few = corpus.limit(40)
    a, b = (language.fit(d, texts=5, windows=2) for d in (few, few.repartition(5)))
    assert all(np.array_equal(p, q) for p, q in zip(a.parameters(), b.parameters()))
    assert zlib.crc32(b"1") % 3 in (0, 1, 2)
