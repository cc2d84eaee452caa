"""Byte-level BPE by a lexicon of frequent words, kept as a minimal acyclic transducer.

The words of all documents are counted. The most frequent ones are merged once and compiled into an automaton that
shares beginnings and endings of words and has as few states as that allows. Its arcs carry numbers; their sum along
a word's path is the word's place in the list of ids. The automaton, the merges and the classes of characters are
one file in the shared folder, which workers map into memory. A slice of texts is cut into words, its distinct words
walk through the automaton together, and words that it doesn't hold are merged exactly, by the tokenizer's ranks. So
the lexicon decides the speed and never the ids.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import SLICE_BYTES, col, file_system, slices, with_arrow
from tickloom.session import scratch_path, written

# The lexicon's bounds: how many words, and the bytes of a word. Other words are merged when they occur.
LEXICON_WORDS, WORD_BYTES = 60_000, 48
# From so many bytes on a word's merges are done rank by rank on arrays.
LONG_WORD = 512
NEVER = 1 << 30
# Classes of characters; NONE stands before a text's first.
LETTER, NUMBER, SIGN, WHITE, NONE = range(5)
# What the tokenizer's pattern cuts off a word after an apostrophe.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")
_POINTS, _PROBED = 0x110000, 256
# Cells of a group of words that are merged together.
_CELLS = 1 << 19
# A multiplier that spreads pairs over slots, and the slots' number as a power of two.
_HASH, _SLOT_BITS = np.int64(-7046029254386353131), 20


# --- cutting texts into words ------------------------------------------------------------------


def character_classes(tokenizer) -> np.ndarray:
    """The class of every code point, as the tokenizer's own cutting shows it.

    Set between a letter, a digit and a sign, a character joins the neighbour of its class. So the classes are
    those of the installed library, whatever version of Unicode it follows.
    """
    cut = tokenizer.pre_tokenizer.pre_tokenize_str
    points = [c for c in range(_POINTS) if not 0xD800 <= c < 0xE000]
    # above ASCII, neighbours of one piece are of one class: only a piece's first is set between the others
    firsts = points[:128]
    for k in range(128, len(points), _PROBED):
        block = points[k : k + _PROBED]
        firsts += [block[a] for _, (a, _) in cut("".join(map(chr, block)))]
    kinds = np.full(_POINTS, NONE, np.uint8)
    for k in range(0, len(firsts), _PROBED):
        some = firsts[k : k + _PROBED]
        starts = np.zeros((len(some), 6), bool)
        starts.reshape(-1)[[a for _, (a, _) in cut("".join(f"\na{chr(c)}1.{chr(c)}" for c in some))]] = True
        kinds[some] = np.select([~starts[:, 2], ~starts[:, 3], ~starts[:, 5]], [LETTER, NUMBER, SIGN], WHITE)
    kinds[[9, 10, 11, 12, 13, 32]] = WHITE  # the blank joins what follows it
    told = np.maximum.accumulate(np.where(kinds != NONE, np.arange(_POINTS), 0))
    return kinds[told]


def piece_starts(points: np.ndarray, begins: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where words begin: runs of one class, a blank joining the run it stands before.

    Of white space before a run the last character is a word of its own or that blank, the rest another word.
    ``begins`` marks where texts begin in ``points``.
    """
    kind = classes[points]
    white = kind == WHITE
    before = np.empty(len(kind), np.uint8)
    before[1:], before[0] = kind[:-1], NONE
    before[begins] = NONE
    follows = np.zeros(len(kind), bool)
    follows[:-1] = ~white[1:] & ~begins[1:]
    after_blank = np.zeros(len(kind), bool)
    after_blank[1:] = points[:-1] == 0x20
    after_blank &= ~begins
    starts = np.where(white, (before != WHITE) | follows, (before != kind) & ~after_blank)
    at = np.flatnonzero(starts & (points == ord("'")))
    # padded by two that match nothing, so that no ending crosses the end
    far, edge = np.append(points, [0, 0]), np.append(begins, [True, True])
    first, second = far[at + 1] * ~edge[at + 1], far[at + 2] * ~edge[at + 2]
    short = np.isin(first, [ord(c) for c in SHORT_ENDINGS])
    long = np.zeros(len(at), bool)
    for a, b in LONG_ENDINGS:
        long |= (first == ord(a)) & (second == ord(b))
    starts = np.append(starts, [False] * 4)
    starts[at[short | long] + 1] = False
    starts[at[short] + 2] = True
    starts[at[long] + 3] = True
    return starts[: len(kind)]


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets and the bytes of a column of strings or binaries without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def _binary(starts: np.ndarray, data: np.ndarray) -> pa.Array:
    """A column of the parts of some bytes that begin at ``starts``, which begins with 0."""
    ends = np.append(starts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def words_of(texts: pa.Array, classes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and the words of all texts one after the other."""
    offsets, data = _bytes_of(texts)
    if not len(data):
        return np.zeros(len(texts), np.int64), pa.array([], pa.large_binary())
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    place = np.cumsum(width) - width
    begins = np.zeros(len(points), bool)
    begins[np.searchsorted(place, offsets[:-1][np.diff(offsets) > 0])] = True
    starts = place[piece_starts(points, begins, classes)]
    return np.diff(np.searchsorted(starts, offsets)), _binary(starts, data)


# --- the automaton -----------------------------------------------------------------------------


def compile_words(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of distinct words in ascending order.

    Words are added one after the other; what can no longer change of the last one is shared with a state that
    has the same arcs, if there is one. An arc is the number of its state times 256 plus its byte; ``adds`` sum up
    to the number of smaller words.
    """
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path: list[tuple[int, int]] = []  # arcs (state, byte) of the last word that are not shared yet
    free: list[int] = []

    def share(depth: int) -> None:
        while len(path) > depth:
            state, byte = path.pop()
            end = arcs[state][byte]
            form = (final[end], *arcs[end].items())
            same = known.setdefault(form, end)
            if same != end:
                arcs[state][byte] = same
                arcs[end] = {}
                free.append(end)

    last = b""
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        share(common)
        state = arcs[path[-1][0]][path[-1][1]] if path else 0
        for byte in word[common:]:
            if free:
                end = free.pop()
                final[end] = False
            else:
                end = len(arcs)
                arcs.append({})
                final.append(False)
            arcs[state][byte] = end
            path.append((state, byte))
            state = end
        final[state] = True
        last = word
    share(0)
    counts: dict[int, int] = {}
    stack = [0]
    while stack:  # the words that end below each state
        state = stack[-1]
        open_ = [t for t in arcs[state].values() if t not in counts]
        if open_:
            stack += open_
        else:
            counts[state] = final[state] + sum(counts[t] for t in arcs[state].values())
            stack.pop()
    keys, targets, adds = [], [], []
    for state in sorted(counts):
        before = int(final[state])
        for byte, end in sorted(arcs[state].items()):
            keys.append(state << 8 | byte)
            targets.append(end)
            adds.append(before)
            before += counts[end]
    return {"arcs": np.array(keys, np.int64), "targets": np.array(targets, np.int64),
            "adds": np.array(adds, np.int64), "final": np.array(final, bool)}


# --- the lexicon -------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it shows, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def read_tokenizer(path: str) -> dict[str, np.ndarray]:
    """The merges, the bytes of each id and the classes of characters of a byte-level BPE tokenizer's file.

    Truncation and padding are not looked at. Raises ValueError where the file asks for what this module doesn't do.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += [k for t in added for k in ("single_word", "lstrip", "rstrip", "normalized") if t.get(k)]
    if model.get("type") != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or spec.get("normalizer") or odd:
        raise ValueError(f"not a plain byte-level BPE tokenizer: {path} {odd}")
    letters, vocabulary = _byte_letters(), model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left, right = (np.array([vocabulary[p[k]] for p in pairs], np.int64) for k in (0, 1))
    merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
    born = np.full(max(vocabulary.values()) + 1, -1)
    born[merged] = np.arange(len(merged))
    if len(merged) and (np.maximum(born[left], born[right]) >= np.arange(len(merged))).any():
        raise ValueError(f"a merge stands before those of its parts: {path}")
    text = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items()} | {t["id"]: t["content"].encode() for t in added}
    size = max(text, default=-1) + 1
    keys = left << 32 | right
    order = np.argsort(keys)
    byte_ids = np.full(256, -1, np.int64)
    for letter, b in letters.items():
        byte_ids[b] = vocabulary[letter]
    return {
        "classes": character_classes(Tokenizer.from_file(path)), "byte_ids": byte_ids,
        "pairs": keys[order], "ranks": order.astype(np.int64), "merged": merged,
        "token_at": np.cumsum([0, *[len(text.get(i, b"")) for i in range(size)]]).astype(np.int64),
        "token_bytes": np.frombuffer(b"".join(text.get(i, b"") for i in range(size)), np.uint8),
        "special": np.frombuffer(json.dumps({t["content"]: t["id"] for t in added}).encode(), np.uint8),
    }


class Lexicon:
    """The automaton, the merges and the classes, over the arrays of a lexicon's file."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.__dict__.update(arrays)
        self.specials: dict[str, int] = json.loads(self.special.tobytes())
        # the longest of several that begin in one place
        marks = sorted(self.specials, key=len, reverse=True)
        self.special_pattern = re.compile("|".join(map(re.escape, marks))) if marks else None
        self.by_rank = np.empty(len(self.pairs), np.int64)
        self.by_rank[self.ranks] = self.pairs
        # a pair's rank where its hash says, of several in one slot that of the last
        self.slots = np.full(1 << _SLOT_BITS, -1, np.int32)
        self.slots[(self.by_rank * _HASH).view(np.uint64) >> np.uint64(64 - _SLOT_BITS)] = np.arange(len(self.pairs))

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each word among the lexicon's, -1 for those it doesn't hold; all words walk together."""
        offsets, data = _bytes_of(words)
        size, at = np.diff(offsets), offsets[:-1]
        place, state, total = np.full(len(words), -1), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        live, step = np.arange(len(words)), 0
        while len(live) and len(self.arcs):
            ended = size[live] == step
            done = live[ended]
            place[done] = np.where(self.final[state[done]], total[done], -1)
            live = live[~ended]
            key = state[live] << 8 | data[at[live] + step]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            there = self.arcs[arc] == key
            live, arc = live[there], arc[there]
            state[live] = self.targets[arc]
            total[live] += self.adds[arc]
            step += 1
        return place

    def merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each word and all ids: of each word the first pair of least rank is merged, until none is left.

        Words of about a length are the rows of a matrix and take their next merge together.
        """
        offsets, data = _bytes_of(words)
        size, counts = np.diff(offsets), np.ones(len(words), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # where ids belong, and the ids
        order = np.argsort(size, kind="stable")
        order = order[size[order] > 0]
        counts[size == 0] = 0
        k = 0
        while k < len(order):
            longest = 4 << max(0, int(size[order[k]] - 1).bit_length() - 2)
            if size[order[k]] >= LONG_WORD:
                rows, k = order[k : k + 1], k + 1
                ids = self.merge_long(data[offsets[rows[0]] : offsets[rows[0] + 1]])[None]
                left = np.array([ids.shape[1]])
            else:
                to = int(np.searchsorted(size[order], min(longest, LONG_WORD - 1), side="right"))
                to = min(to, k + max(1, _CELLS // longest))
                rows, k = order[k:to], to
                width = int(size[rows[-1]])
                at = offsets[rows, None] + np.arange(width)
                ids = np.where(np.arange(width) < size[rows, None], self.byte_ids[data[np.minimum(at, len(data) - 1)]], -1)
                ids, left = self._merge_rows(ids.astype(np.int32), size[rows].copy())
            counts[rows] = left
            found.append((rows, ids[np.arange(ids.shape[1]) < left[:, None]]))
        ends = np.cumsum(counts)
        flat = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        for rows, ids in found:
            n = counts[rows]
            flat[np.repeat(ends[rows] - n - (np.cumsum(n) - n), n) + np.arange(n.sum())] = ids
        return counts, flat

    def _merge_rows(self, ids: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merged words in the rows of a matrix, and how many ids are left of each; -1 fills a row."""
        out = ids.copy()
        rows, place = np.arange(len(ids)), np.arange(ids.shape[1])
        ranks = np.full(ids.shape, NEVER, np.int32)
        ranks[:, :-1] = self._ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1)
            here = np.arange(len(rows))
            least = ranks[here, at]
            done = least == NEVER
            if done.any():
                out[rows[done]] = ids[done]
                rows, ids, ranks, at, least = rows[~done], ids[~done], ranks[~done], at[~done], least[~done]
                here = np.arange(len(rows))
                if not len(rows):
                    break
            # what stands behind the pair moves up by one
            ids[:, :-1] = np.where(place[:-1] > at[:, None], ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(place[:-1] > at[:, None], ranks[:, 1:], ranks[:, :-1])
            ids[:, -1] = -1
            ranks[:, -1] = NEVER
            ids[here, at] = self.merged[least]
            left[rows] -= 1
            ranks[here, at] = self._ranks(ids[here, at], ids[here, np.minimum(at + 1, len(place) - 1)])
            ranks[here[at == len(place) - 1], -1] = NEVER
            inner = at > 0
            ranks[here[inner], at[inner] - 1] = self._ranks(ids[here[inner], at[inner] - 1], ids[here[inner], at[inner]])
        return out, left

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; ids below 0 pair with nothing."""
        key = left.astype(np.int64) << 32 | right
        slot = (key * _HASH).view(np.uint64) >> np.uint64(64 - _SLOT_BITS)
        rank = self.slots[slot]
        missed = (rank >= 0) & (self.by_rank[rank] != key)
        if missed.any():  # another pair has the slot
            again = np.minimum(np.searchsorted(self.pairs, key[missed]), len(self.pairs) - 1)
            rank[missed] = np.where(self.pairs[again] == key[missed], self.ranks[again], -1)
        return np.where((rank >= 0) & (left >= 0) & (right >= 0), rank, NEVER)

    def merge_long(self, word: np.ndarray) -> np.ndarray:
        """As :meth:`merge`, all pairs of a rank at once: a new pair's rank is above that of the merge that made it."""
        n = len(word)
        ids = self.byte_ids[word].astype(np.int32)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[-1] = -1
        gone = np.zeros(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray) -> None:
            ranks = self._ranks(ids[at], np.where(after[at] < 0, -1, ids[after[at]]))
            at, ranks = at[ranks < NEVER], ranks[ranks < NEVER]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            edges = np.flatnonzero(np.diff(ranks, prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(at)]):
                r = int(ranks[a])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(at[a:b])

        for k in range(0, n, 1 << 20):
            add(np.arange(k, min(n, k + (1 << 20)), dtype=np.int32))
        while heap:
            rank = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(rank)))
            at = at[~gone[at]]
            at = at[self._ranks(ids[at], np.where(after[at] < 0, -1, ids[after[at]])) == rank]
            if not len(at):
                continue
            if self.by_rank[rank] >> 32 == self.by_rank[rank] & 0xFFFFFFFF:
                # equal parts: of a run of overlapping pairs the first, third and so on
                follows = np.append(False, after[at[:-1]] == at[1:])
                first = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            end = after[at]
            ids[at], gone[end] = self.merged[rank], True
            after[at] = after[end]
            there = after[at] >= 0
            before[after[at][there]] = at[there]
            left = before[at]
            add(np.unique(np.concatenate([left[left >= 0], at])))
        return ids[~gone]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text and all ids one after the other; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        parts, owner, marks = [], [], []  # what stands between special tokens, whose it is, the id that follows
        marked = np.zeros(len(texts), bool)
        for mark in self.specials:
            marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        long = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 2 * SLICE_BYTES
        if not marked.any() and not long.any():
            return self._plain(texts)
        for k in range(len(texts)):
            at, text = 0, texts[k].as_py()
            for m in self.special_pattern.finditer(text) if marked[k] else ():
                parts.append(text[at : m.start()])
                marks.append(self.specials[m.group()])
                at = m.end()
            parts.append(text[at:])
            marks.append(-1)
            owner += [k] * (len(parts) - len(owner))
        counts, found = [], []
        for part, mark in zip(parts, marks):
            ids = [self._plain(pa.array([p], pa.large_string()))[1] for p in _cut(part)]
            found += ids + ([np.array([mark], np.uint32)] if mark >= 0 else [])
            counts.append(sum(map(len, ids)) + (mark >= 0))
        return np.bincount(owner, counts, len(texts)).astype(np.int64), np.concatenate(found)

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        each, words = words_of(texts, self.classes)
        coded = words.dictionary_encode()
        place = self.find(coded.dictionary)
        unseen = np.flatnonzero(place < 0)
        sizes, merged = self.merge(coded.dictionary.take(pa.array(unseen)))
        count = np.diff(self.word_at)[place] if len(self.word_at) > 1 else np.zeros(len(place), np.int64)
        first = self.word_at[place]
        count[unseen], first[unseen] = sizes, len(self.word_ids) + np.cumsum(sizes) - sizes
        flat = np.concatenate([self.word_ids, merged])
        codes = coded.indices.to_numpy()
        lengths = count[codes]
        ends = np.append(0, np.cumsum(lengths))
        at = np.repeat(first[codes] - ends[:-1], lengths)
        at += np.arange(ends[-1])
        borders = np.append(0, np.cumsum(each))
        return np.diff(ends[borders]), flat[at]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes that runs of ids stand for; an id that the vocabulary doesn't have stands for none."""
        known = ids < len(self.token_at) - 1
        token = np.where(known, ids, 0).astype(np.int64)
        sizes = np.where(known, self.token_at[token + 1] - self.token_at[token], 0)
        ends = np.append(0, np.cumsum(sizes))
        at = np.repeat(self.token_at[token] - ends[:-1], sizes)
        at += np.arange(ends[-1])
        data, edges = self.token_bytes[at].tobytes(), ends[np.append(0, np.cumsum(counts))]
        return [data[a:b] for a, b in zip(edges, edges[1:])]


def _cut(text: str) -> Iterator[str]:
    """A very long text in parts that begin at a blank between two other characters, where a word always begins."""
    step, at = SLICE_BYTES // 2, 0
    inside = re.compile(r"(?<=\S) (?=\S)")
    while len(text) - at > 2 * step:
        m = inside.search(text, at + step)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


# --- files and data frames ---------------------------------------------------------------------


def _write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays one after the other at multiples of 64 bytes, behind a line that says which."""
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = (str(a.dtype), len(a), at)
        at += -(-a.nbytes // 64) * 64
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 64) + b"\n"
    where, place = file_system(path)
    where.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with where.open_output_stream(place) as out:
        out.write(line)
        for a in arrays.values():
            out.write(a.tobytes() + bytes(-a.nbytes % 64))


@lru_cache(maxsize=1)
def lexicon_at(path: str) -> Lexicon:
    """The lexicon of a file: mapped into memory where the folder is mounted, read elsewhere."""
    where, place = file_system(path)
    source = pa.memory_map(place) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(place)
    data = source.read_buffer()
    start = data[: min(1 << 16, data.size)].to_pybytes().index(b"\n") + 1
    head = json.loads(data[:start].to_pybytes())
    return Lexicon({
        name: np.frombuffer(data, kind, count, start + at) if count else np.zeros(0, kind)
        for name, (kind, count, at) in head.items()})


def frequent_words(
    docs: DataFrame, classes: np.ndarray, most: int = LEXICON_WORDS, text_col: str = "text",
) -> list[bytes]:
    """The words that occur most often in all texts, of at most ``WORD_BYTES`` bytes; up to ``most`` of them.

    Words are counted in slices, so a word that fills a third of all texts is one row of a slice. Counts are put
    into classes, sixteen for each doubling, and the words of the highest classes that hold no more than ``most`` are
    taken, so that these words alone reach the driver.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            for text in _short(batch.column(0)):
                found = pc.value_counts(words_of(text, classes)[1])
                words = found.field("values")
                small = pc.less_equal(pc.binary_length(words), WORD_BYTES)
                yield pa.RecordBatch.from_arrays(
                    [words.filter(small).cast(pa.binary()), found.field("counts").filter(small)], names=["word", "n"])

    texts = docs.select(col(docs, text_col).alias("text")).filter(F.col("text") != "")
    counts = texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # at most some thousand classes
    classed = written(counts.select("word", F.floor(16 * F.log2("n")).alias("class")), "word-counts")
    sizes = sorted(((r["class"], r["count"]) for r in classed.groupBy("class").count().collect()), reverse=True)
    taken, lowest = 0, None
    for kind, size in sizes:
        if taken + size > most:
            break
        taken, lowest = taken + size, kind
    if lowest is None:
        return []
    return [bytes(r.word) for r in classed.filter(F.col("class") >= lowest).select("word").collect()]


def _short(texts: pa.Array) -> Iterator[pa.Array]:
    """A slice's texts, a very long one in parts."""
    if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > 2 * SLICE_BYTES:
        for part in _cut(texts[0].as_py()):
            yield pa.array([part], pa.large_string())
    else:
        yield texts


def build_lexicon(docs: DataFrame, tokenizer: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compile the frequent words of ``docs`` for a tokenizer; returns the path of the file in the shared folder.

    ``words`` bounds what the driver and each worker hold. An empty table gives a lexicon without words.
    """
    arrays = read_tokenizer(tokenizer)
    return write_lexicon(
        arrays, frequent_words(docs, arrays["classes"], words, text_col), f"{scratch_path(docs.sparkSession, 'lexicon')}/words")


def write_lexicon(arrays: dict[str, np.ndarray], words: list[bytes], path: str) -> str:
    listed = sorted(set(words))
    empty = {"arcs": np.zeros(0, np.int64), "word_at": np.zeros(1, np.int64), "word_ids": np.zeros(0, np.uint32)}
    plain = Lexicon(arrays | empty)
    counts, ids = plain.merge(pa.array(listed, pa.large_binary()))
    _write(path, arrays | compile_words(listed) | {"word_at": np.append(0, np.cumsum(counts)), "word_ids": ids})
    return path


def encode(
    docs: DataFrame, lexicon: str, into: str = "ids", text_col: str = "text", decoded: str | None = None,
) -> DataFrame:
    """``docs`` with a binary column ``into``: the ids of each whole text, little-endian unsigned 32-bit.

    With ``decoded`` also a column of that name: the text that those ids stand for. A null or empty text has no ids.
    The string of a special token in a text is that token, as the library has it. Nothing is shuffled; a task holds
    a slice of texts, or one text if that is longer, which it encodes in parts; repeated rows each get theirs; an
    empty table stays empty. Other columns stay, whatever they are called; the new names must not be among them.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        tool = lexicon_at(lexicon)
        counts, ids = tool.encode(texts)
        edges = np.append(0, np.cumsum(counts))[:-1] * 4
        coded = _binary(edges, ids.astype("<u4").view(np.uint8)).cast(pa.binary())
        if decoded is None:
            return [coded]
        return [coded, pa.array([b.decode("utf-8", "replace") for b in tool.decode(ids, counts)], pa.string())]

    names = [f"`{into}` binary"] + ([f"`{decoded}` string"] if decoded else [])
    return with_arrow(docs, text_col, names, run)


def decode(coded: DataFrame, lexicon: str, ids_col: str = "ids", into: str = "text") -> DataFrame:
    """``coded`` with a column ``into``: the text of each row's ids, special tokens included.

    Null ids give a null text. Bytes that are no text become U+FFFD, and ids that the vocabulary doesn't have are
    passed over. Rows, other columns and slices are as in :func:`encode`.
    """

    def run(column: pa.Array) -> list[pa.Array]:
        offsets, data = _bytes_of(pc.fill_null(column, b""))
        found = lexicon_at(lexicon).decode(np.frombuffer(data.tobytes(), "<u4"), np.diff(offsets) // 4)
        valid = column.is_valid().to_pylist()
        return [pa.array([b.decode("utf-8", "replace") if v else None for b, v in zip(found, valid)], pa.string())]

    return with_arrow(coded, ids_col, [f"`{into}` string"], run)
