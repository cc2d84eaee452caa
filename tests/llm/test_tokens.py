import random

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import tokens

PATH = tokens.public_tokenizer("word_bpe_49k.json")
ALPHABET = list("aAzZ'sStTlL.,!$%&'\"<>|é ÉH̱́ßİıKक़़क01² \n\t\x0b  \u0085\x1c漢日🙂‍Σς—_-")
ALPHABET += ["'s", "'re", "don't", " ", "<|endoftext|>", "<|", "|>"]


def same(texts, path=PATH):
    tool = tokens.Encoder(path)
    counts, ids = tool.encode(pa.array(texts, pa.string()))
    want = tool.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert counts.tolist() == [len(e.ids) for e in want]
    assert ids.tolist() == [i for e in want for i in e.ids]


def test_words_give_the_library_ids():
    pick = random.Random(3)
    same(["".join(pick.choices(ALPHABET, k=pick.randint(0, 50))) for _ in range(3000)] + [None, "", " ", "\n"])


def test_a_very_long_text_is_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_BYTES", 64)
    pick = random.Random(4)
    long = " ".join("".join(pick.choices("abcdé.,'", k=pick.randint(1, 30))) for _ in range(400))
    same([long])
    same(["x" * 500])


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 10)
    tool = tokens.Encoder(PATH)
    texts = [f"word{k} and more{k % 7}" for k in range(50)]
    whole = tool.tokenizer.encode_batch(texts)
    for _ in range(2):
        for t, e in zip(texts, whole):
            assert tool.encode(pa.array([t]))[1].tolist() == e.ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_tokenizers_get_whole_texts(name):
    path = tokens.public_tokenizer(name)
    assert not tokens.Encoder(path).by_word
    same(["Hello  World", None, "a\tb"], path)


def test_no_texts():
    counts, ids = tokens.Encoder(PATH).encode(pa.array([], pa.string()))
    assert len(counts) == len(ids) == 0 and ids.dtype == np.uint32
