import duckdb
import pytest

from tickloom.llm import quality
from tickloom.llm.queries import SQL

PROSE = "The end of the story is that the people of the town went to the river and then on to the hills with joy. "
TEXTS = {
    "null": None, "empty": "", "spaces": " \n\t \n", "short": "the end", "prose": PROSE + "\n".join(f"number{k} of{k} the list{k} and end{k}" for k in range(40)),
    "repeats": "The " * 400, "symbols": " ".join(f"the$$$ word{k}" for k in range(200)), "shouts": " ".join(f"the word{k}!!" for k in range(200)),
    "table": " ".join(f"the word{k} |" for k in range(200)), "lines": "\n".join(["same line of the text here"] * 30 + [f"{k} and the other" for k in range(30)]),
    "no stop words": " ".join(f"word{k}" for k in range(200)), "long": " ".join(f"the w{k}" for k in range(40000)),
    "bullets": "\n".join(f"- the item {k} in" for k in range(40)), "unfinished": "\n".join(f"and the item {k} ..." for k in range(40)),
    "wide": " ".join(f"the {'x' * 40}{k}" for k in range(100)), "controls": "a\x0bb\x0cc\rd\te  f a b c",
}


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(k, text, name, "q") for k, (name, text) in enumerate(TEXTS.items())] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, q_words string")
    return docs, quality.judged(docs)


def test_against_sql(judged):
    docs, found = judged
    db = duckdb.connect()
    documents = docs.select("doc_id", "text").toPandas()
    db.register("documents", documents)
    want = db.execute(SQL["op5_quality_rules"]).fetchall()
    names = [d[0] for d in db.description]
    got = found.select("doc_id", *[f"quality.{n}" for n in names[1:]]).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_verdicts(judged):
    by = {r["n_words"]: r.quality for r in judged[1].collect()}
    assert [n for n, q in by.items() if q.kept] == ["prose", "long"]
    assert "symbols" in by["symbols"].failed and "exclamations" in by["shouts"].failed
    assert "stop_words" in by["no stop words"].failed and "repeated_lines" in by["lines"].failed
    assert "bullet_lines" in by["bullets"].failed and "unfinished_lines" in by["unfinished"].failed
    assert "letterless_words" in by["table"].failed and "word_length" in by["wide"].failed
    assert by["repeats"].base_failed and by["empty"].base_failed and not by["symbols"].base_failed


def test_columns_and_empty(judged):
    docs, found = judged
    assert found.columns == [*docs.columns, "quality"]
    assert quality.judged(docs.limit(0)).count() == 0


def test_no_user_function(judged):
    plan = judged[1]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_repeated_windows_by_brute_force(judged):
    for r in judged[1].collect():
        w = (r.text or "").split()
        w = [x for x in w if x]
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        if len(w) < 1000:
            inside = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
            assert r.quality.n_repeat_words == len(inside) and r.quality.n_words == len(w)
