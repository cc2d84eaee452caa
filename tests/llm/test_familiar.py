import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline

FIRST = 10**9
FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
    "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza.",
]


def gibberish(pick, n):
    letters = pick.choice(["abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz"])
    return " ".join("".join(pick.choices(letters, k=pick.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="module", params=[None, "en"])
def judged(spark, small_documents, request):
    """What is planted, unlabelled or called English, and the ids that stay of it and of the given documents."""
    pick = random.Random(4)
    clean = small_documents.filter(F.col("text").rlike(r"\p{L}") & (F.length("text") > 300)).collect()
    of = {lang: [r.text.split() for r in clean if r.lang == lang] for lang in ("de", "en", "es", "fr")}
    words = [" ".join(w for group in zip(*(pick.choice(of[lang]) for lang in sorted(of))) for w in group) for _ in range(10)]
    parts = [" ".join(w for lang in sorted(of) for w in pick.choice(of[lang])[:60]) for _ in range(10)]
    planted = {"foreign": FOREIGN, "gibberish": [gibberish(pick, n) for n in (5, 40, 40, 400)] + ["x9kq q2zv7 " * 30], "mixed": words + parts}
    rows, ids = [], {}
    for kind, texts in planted.items():
        for t in texts:
            ids[FIRST + len(rows)] = kind
            rows.append((FIRST + len(rows), t, None if kind == "mixed" else request.param, "planted", len(t)))
    docs = small_documents.unionByName(spark.createDataFrame(rows, small_documents.schema))
    return ids, {r.doc_id for r in corpus_pipeline.known_language(spark, docs, "").collect()}


def test_texts_in_no_learned_language_go(judged):
    ids, stay = judged
    assert [d for d, kind in ids.items() if kind in ("foreign", "gibberish") and d in stay] == []


def test_mixed_and_clean_texts_stay(judged, small_documents):
    ids, stay = judged
    assert [d for d, kind in ids.items() if kind == "mixed" and d not in stay] == []
    letters = {r.doc_id for r in small_documents.filter(F.col("text").rlike(r"\p{L}")).collect()}
    assert len(letters & stay) >= 0.99 * len(letters)


def _labelled(spark, labels):
    texts = ["the cat sat on the mat and looked at the dog", "le chat est sur la table dans la maison", None, "1234 5678"]
    rows = [(k, texts[k % len(texts)], labels[k % len(labels)], "own", 0) for k in range(12)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")


def test_the_network_runs_only_where_it_can_reject(spark, monkeypatch):
    """Its verdict is the likeliest learned label: without ``und`` among them it rejects nothing and is not trained."""
    from tickloom.llm import language

    trained, fit = [], language.fit_sample
    monkeypatch.setattr(language, "fit_sample", lambda found: trained.append(len(found)) or fit(found))
    stay = {r.doc_id for r in corpus_pipeline.known_language(spark, _labelled(spark, ["en", "fr"]), "").collect()}
    assert trained == [] and stay == {k for k in range(12) if k % 4 < 2}
    corpus_pipeline.known_language(spark, _labelled(spark, ["en", language.UNKNOWN]), "").collect()
    assert len(trained) == 1
