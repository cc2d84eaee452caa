import random

from tickloom.llm import licenses as lic


def known():
    return [lic.Template.of(n, t) for n, t in lic.TEMPLATES.items()]


def names(text):
    return [x["license"] for x in lic.scan(text, known(), lic.COVERAGE, lic.STRETCH)]


def test_rising_is_the_longest():
    def longest(v):
        best = [1] * len(v)
        for i in range(len(v)):
            best[i] = 1 + max([best[j] for j in range(i) if v[j] < v[i]], default=0)
        return max(best, default=0)

    pick = random.Random(1)
    for _ in range(300):
        v = pick.sample(range(30), pick.randint(0, 12))
        got = [v[k] for k in lic.rising(v)]
        assert got == sorted(got) and len(got) == longest(v)


def test_alignment_rises_and_matches():
    pick = random.Random(2)
    for _ in range(300):
        a, b = ([pick.choice("abcdefghij") for _ in range(pick.randint(0, 15))] for _ in range(2))
        pairs = lic.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(lic.align(a, a)) == len(a)


def test_every_template_is_found_whole_and_changed():
    noise = "ondi the erth of and tion to in is ething that other with " * 30
    for name, text in lic.TEMPLATES.items():
        assert name in names(text)
        hits = lic.scan(noise + text + " " + noise + text.upper() + noise, known(), lic.COVERAGE, lic.STRETCH)
        own = [h for h in hits if h["license"] == name]
        assert len(own) == 2 and own[0]["coverage"] == own[1]["coverage"] == 1
        words = text.split()
        if len(words) > 20:
            for k in range(5, len(words), 12):
                words[k] = "changed"
            assert name in names(noise + " ".join(words) + noise)


def test_prose_has_none_and_close_notices_differ():
    assert names("the license of the work and its version under which all is done " * 50) == []
    for kind in ("cc-by-4.0", "cc-by-sa-4.0", "cc-by-nc-4.0"):
        assert names(lic.TEMPLATES[kind]) == [kind]
    assert names(None) == names("") == []


def test_as_a_column(spark):
    rows = [(1, "All rights reserved.", "x"), (2, None, "y"), (2, None, "y"), (3, "ß All  RIGHTS\nreserved", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = lic.with_licenses(docs).orderBy("doc_id").collect()
    assert [[(x.license, x.start, x.end) for x in r.licenses] for r in got] == [
        [("all-rights-reserved", 0, 19)], [], [], [("all-rights-reserved", 2, 22)]]
    assert lic.with_licenses(docs.limit(0)).count() == 0
    assert lic.with_licenses(docs, templates={"none": "..."}).first().licenses == []
