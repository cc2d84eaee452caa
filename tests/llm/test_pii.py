import random
import re
import time
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import pii


def spans(text):
    return [(pii.KINDS[k], text[s:e]) for s, k, e in pii.base_spans(text)]


def test_patterns():
    assert spans("a b.c+d@x-y.example.com, z") == [("email", "b.c+d@x-y.example.com")]
    assert spans("10.0.0.255 and 10.0.0.256 and 1.2.3") == [("ip", "10.0.0.255")]
    assert spans("4532015112830366 4532015112830367") == []  # one match of 32 digits, no second try
    assert spans("x 4532 0151 1283 0366.") == [("card", "4532 0151 1283 0366")]
    assert spans("call +1 (988) 555-2485 now +1 2") == [("phone", "+1 (988) 555-2485")]
    assert spans("") == []
    assert spans("١٢٣٤٥٦٧٨٩٠١٢٣") == []  # digits of other scripts are letters here
    assert [k for k, _ in spans("+4532015112830366")] == ["card"] and pii.luhn("0") and not pii.luhn("1")
    assert spans("0010.0000.1.2")[0][0] == "ip"


def test_patterns_are_the_plain_ones_and_linear():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@-_% 2") for _ in range(rng.randint(0, 40)))
        assert list(pii._addresses(text)) == [m.span() for m in email.finditer(text)], text
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in ip.finditer(text)], text
    started = time.perf_counter()
    for text in ("a" * 1_000_000 + "@", "a@" * 500_000, " @b.c" * 200_000, "1" * 1_000_000 + ".", "1.1 " * 250_000,
                 "+1" + "-" * 1_000_000, "+1-" * 300_000):
        assert pii.base_spans(text) == [], text[:10]
    assert time.perf_counter() - started < 30


def tiny(cells=2, seed=0, kind=np.float64):
    rng = np.random.default_rng(seed)
    f = lambda *s: rng.normal(0, 0.6, s).astype(kind)
    make = lambda: pii.Reader(f(pii.CLASSES, 4 * cells), f(cells, 4 * cells))
    k = len(pii.TAGS)
    return pii.Tagger(make(), make(), f(2 * cells, k), f(k), f(k, k))


def test_decoding_and_likelihood_by_all_paths():
    model, codes = tiny(), np.random.default_rng(1).integers(0, 7, (4, 3)).astype(np.uint8)
    scores, _ = model.scores(codes)

    def value(path, w):
        return sum(scores[t, w, p] for t, p in enumerate(path)) + sum(model.steps[a, b] for a, b in zip(path, path[1:]))

    paths = list(product(range(len(pii.TAGS)), repeat=4))
    best = model.decode(codes)
    tags = np.random.default_rng(2).integers(0, len(pii.TAGS), codes.shape)
    for w in range(3):
        assert tuple(best[:, w]) == max(paths, key=lambda p: value(p, w))

    def loss():
        nonlocal scores
        scores, _ = model.scores(codes)
        return sum(np.log(sum(np.exp(value(p, w)) for p in paths)) - value(tags[:, w], w) for w in range(3)) / tags.size

    got, rng = model.gradients(codes, tags), np.random.default_rng(3)
    for p, g in zip(model.parameters(), got):
        for at in zip(*[rng.integers(0, min(n, 7), 4) for n in p.shape]):
            before = p[at]
            p[at] = before + 1e-3
            up = loss()
            p[at] = before - 1e-3
            down = loss()
            p[at] = before
            assert abs((up - down) / 2e-3 - g[at]) < 2e-3


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def tagger(docs):
    return pii.fit(docs)


def test_base_spans_stay_and_skipping_changes_nothing(docs, tagger):
    texts = [r.text for r in docs.filter(F.col("text").rlike("[0-9@]")).limit(60).collect()] + ["", "plain", "@", "7" * 500]
    found = pii.find(texts, tagger)
    assert found == pii.find(texts, tagger, skip=False)
    assert found == [pii.find([t], tagger)[0] for t in texts]  # a text's spans don't depend on others
    for t, spans in zip(texts, found):
        assert set(pii.base_spans(t)) <= set(spans) and spans == sorted(spans)
        assert all(0 <= s < e <= len(t) for s, _, e in spans)


def test_spellings_that_the_patterns_miss(tagger):
    pick, hit, n = random.Random(1), 0, 0
    for k in range(60):
        said = pick.choice([f"hgtr.{k} @ mail{k % 9}.example.com", f"54 . 12 . {k} . 9", f"4532 / 0151 / 1283 / 0366", f"(9{k % 10}8) 555-24{k % 10}5"])
        text = f"the end of the {said} and so on"
        assert not any(s <= 15 and e >= 15 + len(said) for s, _, e in pii.base_spans(text))
        n += 1
        hit += any(text[s:e] == said for s, _, e in pii.find([text], tagger)[0])
    assert hit >= 0.7 * n


def test_prose_has_none(tagger):
    text = "In 1999 the 12 men went to 7 towns; by 2004 there were 300. " * 40
    assert pii.find([text], tagger) == [[]]


def test_windows_are_reconciled(tagger):
    mail = "abcdef.12@mail7.example.com"
    for at in range(0, 120, 7):
        text = "x" * at + " " + mail + " and the rest of it " * 3
        spaced = text.replace("@", " @ ")
        want = (at + 1, at + 1 + len(mail))
        assert want in [(s, e) for s, _, e in pii.find([text], tagger)[0]]
        assert any(s <= at + 12 < e for s, _, e in pii.find([spaced], tagger)[0])


def test_as_columns(spark, tagger):
    rows = [(1, "mail a@b.cc or 10.1.2.3", "x"), (2, None, "y"), (3, "", "z"), (3, "", "z"), (4, "é🙂 a@b.cc", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = pii.with_spans(df, tagger).orderBy("doc_id").collect()
    assert [[(x.kind, x.start, x.end) for x in r.spans if x.base] for r in got] == [
        [("email", 5, 11), ("ip", 15, 23)], [], [], [], [("email", 3, 9)]]
    clean = pii.redacted(df, tagger)
    assert clean.columns == df.columns
    assert [r.text for r in clean.orderBy("doc_id").collect()] == ["mail <email> or <ip>", None, "", "", "é🙂 <email>"]
    assert pii.with_spans(df.limit(0), None).count() == 0
    assert pii.fit(df.limit(0)) is None


def test_runs_of_windows_are_decoded_as_one_text(tagger):
    """The joined windows have the best path of the whole run's scores, steps across their borders included."""
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab@. 0123456789+-"), size=n)) for n in (1, 47, 48, 49, 400, 1000)]
    texts.append("x" * 40 + "abcdef . ghij . klmno . " * 8 + "@ mail7 . example . com and " * 9)
    for text in texts:
        _, starts, windows = pii._windows(text, False)
        first = np.arange(len(starts)) == 0
        got = tagger.reconciled(windows, first).ravel()
        scores = tagger.scores(np.ascontiguousarray(windows.T))[0][pii.MARGIN : pii.WINDOW - pii.MARGIN]
        flat = scores.transpose(1, 0, 2).reshape(-1, len(pii.TAGS)).astype(float)
        best, came = tagger.steps[0] + flat[0], []
        for now in flat[1:]:
            ways = best[:, None] + tagger.steps
            came.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + now
        path = [int(best.argmax())]
        for step in reversed(came):
            path.append(int(step[path[-1]]))
        want = np.array(path[::-1])

        def value(tags):
            before = np.concatenate([[0], tags[:-1]])
            return flat[np.arange(len(tags)), tags].sum() + tagger.steps[before, tags].sum()

        assert abs(value(got) - value(want)) < 1e-2


def test_runs_do_not_touch_each_other(tagger):
    texts = ["call me at 54 . 12 . 7 . 9 now " * 5, "", "name.x @ mail3.example.com " * 9]
    parts = [pii._windows(t, False)[2] for t in texts]
    first = np.concatenate([np.arange(len(p)) == 0 for p in parts])
    alone = [tagger.reconciled(p, np.arange(len(p)) == 0) for p in parts]
    assert np.array_equal(tagger.reconciled(np.concatenate(parts), first), np.concatenate(alone))


NAMES = ["jane.doe", "k_miller", "bob99", "anna-lena.k", "office", "qx.vee", "m.o.brien", "tremaine"]
SPELLINGS = {
    "name @ host": lambda p: f"{p.choice(NAMES)}{p.randrange(90)} @ mail{p.randrange(9)}.example.com",
    "name@host . example . com": lambda p: f"{p.choice(NAMES)}{p.randrange(90)}@mail{p.randrange(9)} . example . com",
    "a . b . c . d": lambda p: f"{p.randrange(1, 224)} . {p.randrange(256)} . {p.randrange(256)} . {p.randrange(256)}",
    "(area) number": lambda p: f"({p.randrange(200, 990)}) 555-{p.randrange(1000, 9999)}",
}


def recall(tagger, spelling, trials=100):
    pick, whole = random.Random(7), 0
    for _ in range(trials):
        said = SPELLINGS[spelling](pick)
        text = f"{pick.choice(['please write to', 'it was sent from', 'reach us under'])} {said} {pick.choice(['and wait', 'by friday', 'for more'])}"
        whole += any(text[s:e] == said for s, _, e in pii.find([text], tagger)[0])
    return whole / trials


@pytest.mark.parametrize("spelling", sorted(SPELLINGS))
def test_recall_by_spelling(tagger, spelling):
    assert recall(tagger, spelling) >= 0.9
