"""Token ids of whole texts.

The tokenizer is one of the ``tokenizers`` library, given by its file. Where it splits texts
into letters, digits and signs before it looks at them, a text's ids are those of its words in
order, so each distinct word of a worker is given to the library once. Any other tokenizer gets
the whole texts. Both ways give the same ids (tested).
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tickloom.llm.common import SLICE_BYTES

# What the tokenizer's file says where the way by words holds.
WORD_END = "</w>"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Letters and signs at whose border a piece always ends. Neither a sign nor a space composes with
# the letter before it, so a space set there changes no id.
# (the capital dotted I is left out: in lower case it is a letter and a mark)
_LETTER = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_SIGN = r"!-/:-@\[-`{-~"
_SIGN_NO_QUOTE = r"!-&(-/:-@\[-`{-~"
# One piece that the tokenizer's normalisation leaves as it is.
_ONE_PIECE = re.compile(rf"[a-zß-öø-ÿ]+|[{_SIGN_NO_QUOTE}]+")
# A worker forgets its words when it holds so many; this bounds memory, not what is encoded.
KEPT_WORDS = 250_000
_JOINED = 40


def public_tokenizer(name: str) -> str:
    """The path of one of the installed vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes batches of texts with one tokenizer; one per Python worker."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        splits = [p.get("pattern", {}).get("Regex") for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.by_word = spec["model"].get("end_of_word_suffix") == WORD_END and PIECES in splits
        # the same model without the steps that leave single lower-case words as they are
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.forget()

    def forget(self) -> None:
        """Hold no words."""
        self.known: dict[str, int] = {}
        self.first = np.zeros(1024, np.int64)
        self.count = np.zeros(1024, np.int64)
        self.flat = np.zeros(8192, np.uint32)
        self.used = 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text and all ids one after the other; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_word:
            return self._whole(texts)
        odd = pa.array(np.zeros(len(texts), bool))
        for mark in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, mark))
        if not pc.any(odd).as_py() and len(texts):
            return self._by_word(texts)
        if not len(texts):
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        whole = odd.to_numpy(zero_copy_only=False)
        parts, counts, at = [], np.zeros(len(texts), np.int64), 0
        while at < len(texts):  # runs of rows that go the same way
            to = at + 1
            while to < len(texts) and whole[to] == whole[at]:
                to += 1
            n, ids = (self._whole if whole[at] else self._by_word)(texts.slice(at, to - at))
            counts[at:to] = n
            parts.append(ids)
            at = to
        return counts, np.concatenate(parts)

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
        counts = np.array([len(x) for x in found], np.int64)
        flat = np.fromiter((i for x in found for i in x), np.uint32, int(counts.sum()))
        return counts, flat

    def _by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        long = len(texts) == 1 and len(texts[0].as_buffer()) > 2 * SLICE_BYTES
        if long and len(cut := _cut(texts[0].as_py())) > 1:
            parts = [self._by_word(pa.array([x], pa.large_string())) for x in cut]
            ids = np.concatenate([p[1] for p in parts])
            return np.array([len(ids)], np.int64), ids
        parted = pc.replace_substring_regex(texts, rf"([{_LETTER}])([{_SIGN}])", r"\1 \2")
        parted = pc.replace_substring_regex(parted, rf"([{_SIGN_NO_QUOTE}])([{_LETTER}])", r"\1 \2")
        # without marks to compose with, ASCII letters may be put in lower case beforehand
        lower = not pc.any(pc.match_substring_regex(parted, r"\p{M}")).as_py()
        parted = pc.ascii_lower(parted) if lower else parted
        lists = pc.ascii_split_whitespace(parted)
        coded = lists.flatten().dictionary_encode()
        place = self._places(coded.dictionary.to_pylist(), lower)[coded.indices.to_numpy()]
        counts = self.count[place]
        ends = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(self.first[place] - ends[:-1], counts)
        at += np.arange(ends[-1])
        borders = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return np.diff(ends[borders]), self.flat[at]

    def _places(self, names: list[str], lower: bool) -> np.ndarray:
        """Where the ids of each word stand; unknown words are encoded first."""
        if len(self.known) > KEPT_WORDS:
            self.forget()
        if not lower:
            names = [w.lower() if w.isascii() else w for w in names]
        missing = [w for w in dict.fromkeys(names) if w not in self.known]
        plain = [w for w in missing if _ONE_PIECE.fullmatch(w)]
        self._learn_joined(plain)
        self._learn([w for w in missing if w not in self.known])
        known = self.known
        return np.fromiter((known[w] for w in names), np.int64, len(names))

    def _learn_joined(self, plain: list[str]) -> None:
        """Words of one piece each, encoded some at a time: an id that ends a piece ends a word."""
        parts = [plain[k : k + _JOINED] for k in range(0, len(plain), _JOINED)]
        coded = self.model.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        names, counts, flat = [], [], []
        for part, found in zip(parts, coded):
            ids = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            # else some word is more than one piece after all: they are encoded one by one
            if len(ends) == len(part) and ends[-1] == len(ids):
                names += part
                counts.append(np.diff(ends, prepend=0))
                flat.append(ids)
        if names:
            self._keep(names, np.concatenate(counts), np.concatenate(flat))

    def _learn(self, missing: list[str]) -> None:
        if missing:
            counts, ids = self._whole(pa.array(missing, pa.large_string()))
            self._keep(missing, counts, ids)

    def _keep(self, names: list[str], counts: np.ndarray, ids: np.ndarray) -> None:
        at, to = len(self.known), len(self.known) + len(names)
        if to > len(self.first):
            self.first = np.resize(self.first, 2 * to)
            self.count = np.resize(self.count, 2 * to)
        if self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (self.used + len(ids)))
        self.count[at:to] = counts
        self.first[at:to] = self.used + np.cumsum(counts) - counts
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.known.update(zip(names, range(at, to)))


def _cut(text: str) -> list[str]:
    """A very long text in parts that begin at white space, so that no word is cut."""
    parts, at, step = [], 0, SLICE_BYTES // 2
    space = re.compile(r"[\x20\x09-\x0D]")
    while at < len(text):
        found = space.search(text, at + step)
        to = found.start() if found else len(text)
        parts.append(text[at:to])
        at = to
    return parts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return Encoder(path)
