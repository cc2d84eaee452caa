import random

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import bpe
from tickloom.llm.common import SLICE_BYTES
from tickloom.llm.queries import QUERIES, table
from tickloom.llm.tokens import public_tokenizer

SF = "/root/testdata/sf0.001"
PATH = public_tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def arrays():
    return bpe.read_tokenizer(PATH)


@pytest.fixture(scope="module")
def lexicon(arrays, tmp_path_factory):
    words = [b" the", b"the", b" then", b"ten", b" in", b"ing", b" ", b"\n", b"'s", " é".encode(), b"ab" * 20]
    return bpe.lexicon_at(bpe.write_lexicon(arrays, words, str(tmp_path_factory.mktemp("lexicon") / "words")))


def same_as_library(tokenizer, lexicon, texts):
    counts, ids = lexicon.encode(pa.array(texts))
    ends = np.cumsum(counts)
    for k, want in enumerate(tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[ends[k] - counts[k] : ends[k]].tolist() == want.ids, texts[k][:100]
    return counts, ids


def test_hostile_texts_get_the_librarys_ids_and_come_back(tokenizer, lexicon):
    rng = random.Random(3)
    signs = [*"aabbst'  \n\t\r.,!'dmrevl1290 éß  　中文\U0001f600́\x1c\x85\x00", "<|endoftext|>", "'re", "'ll", "  ", "<|endo"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(map(chr, rng.sample(points, 40))) for _ in range(500)]
    texts += ["", "'", "'s", " 's", "x's's", "'ve'll'", "a" * 511, "a" * 512, "ab" * 3000, "aaaaaaab" * 900, "é" * 3000, " " * 3000]
    counts, ids = same_as_library(tokenizer, lexicon, texts)
    decoded = lexicon.decode(ids, counts)
    assert [d.decode() for d in decoded] == texts
    whole = tokenizer.encode_batch(texts[:50], add_special_tokens=False)
    assert [tokenizer.decode(e.ids, skip_special_tokens=False) for e in whole] == texts[:50]


def test_every_character_is_cut_as_the_library_does(tokenizer, arrays):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    points = [*points[:0x3000], *points[0x3000::61]]  # the classes are the library's own; this tests the cutting
    for k in range(0, len(points), 256):
        text = "".join(f"a{chr(c)}1{chr(c)}.{chr(c)} {chr(c)}" for c in points[k : k + 256])
        words = bpe.words_of(pa.array([text]), arrays["classes"])[1].to_pylist()
        assert words == [text[a:b].encode() for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def test_matrix_and_rank_by_rank_merges_agree(lexicon):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdethe ") for _ in range(rng.randint(1, 400))).encode() for _ in range(300)]
    counts, ids = lexicon.merge(pa.array(words, pa.large_binary()))
    ends = np.cumsum(counts)
    for k, w in enumerate(words):
        assert ids[ends[k] - counts[k] : ends[k]].tolist() == lexicon.merge_long(np.frombuffer(w, np.uint8)).tolist()


def minimal_states(words):
    """The states of the minimal automaton: the distinct sets of endings."""
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    return len({frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes})


@pytest.mark.parametrize("seed", range(4))
def test_automaton_is_minimal_and_numbers_its_words(seed):
    rng = random.Random(seed)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(120)})
    a = bpe.compile_words(words)
    used = {0, *a["targets"].tolist()}
    assert len(used) == minimal_states(words)
    found = bpe.Lexicon.find(type("L", (), a)(), pa.array([*words, b"abcabcabc", b"zz", b""], pa.large_binary()))
    assert found.tolist() == [*range(len(words)), -1, -1, -1]


def test_very_long_texts_are_cut_where_words_begin(tokenizer, lexicon):
    rng = random.Random(7)
    text = "".join(rng.choice(["word ", "other  ", "\n ", "it's ", "x " * 5, "12 "]) for _ in range(3 * SLICE_BYTES // 4))
    assert len(text) > 2 * SLICE_BYTES and len(list(bpe._cut(text))) > 1
    same_as_library(tokenizer, lexicon, [text, "short"])
    unbroken = "abcdefgh" * (SLICE_BYTES // 16)
    same_as_library(tokenizer, lexicon, [unbroken])


def test_data_frames_with_nulls_repeats_and_clashing_names(spark, tokenizer):
    rows = [(1, None, "x", 1.5), (2, "", "y", 2.5), (3, "The cat's <|endoftext|> hat", "z", None), (3, "The cat's <|endoftext|> hat", "z", None), (None, " a", None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `word.n` string, `0` double")
    path = bpe.build_lexicon(docs, PATH, words=100)
    coded = bpe.encode(docs, path, "ids", decoded="again")
    assert coded.columns == ["doc_id", "text", "word.n", "0", "ids", "again"]
    got = sorted(map(tuple, coded.collect()), key=str)
    want = []
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want.append((*r, bytearray(np.array(ids, "<u4").tobytes()), r[1] or ""))
    assert got == sorted(want, key=str)
    back = bpe.decode(coded.drop("again", "text"), path)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((r[0] or 0, r[1] or "") for r in rows)
    odd = spark.createDataFrame([(bytearray(np.array([70000, 220, 200], "<u4").tobytes()),), (None,)], "ids binary")
    assert {r.text for r in bpe.decode(odd, path).collect()} == {tokenizer.decode([220, 200], skip_special_tokens=False), None}
    empty = docs.limit(0)
    assert bpe.encode(empty, bpe.build_lexicon(empty, PATH), "ids").count() == 0


def test_a_bounded_lexicon_holds_the_most_frequent_words(spark, arrays):
    docs = spark.createDataFrame([("aa " * 50 + "bb " * 30 + "cc dd ee",)], "text string")
    assert sorted(bpe.frequent_words(docs, arrays["classes"], 3)) == [b" aa", b" bb"]
    assert bpe.frequent_words(docs, arrays["classes"], 0) == []


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.read_tokenizer(public_tokenizer("word_bpe_49k.json"))


def test_query_against_the_library(spark, tokenizer):
    from hashlib import sha256

    got = {r.doc_id: r for r in QUERIES["op11_bpe_lexicon"](spark, SF).collect()}
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
