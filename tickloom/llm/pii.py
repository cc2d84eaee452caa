"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF that adds to them.

The patterns find the plain forms. The network reads classes of characters in overlapping windows and tags each
character with the kind of span it is in, the CRF's transitions making the tags of a window agree. A window
decides only its middle, so the decisions of all windows join into one tagging of the whole text, from which the
spans are taken; so a span that crosses windows is found whole. It is trained in numpy, by the gradient of the
CRF's likelihood through the network, on labelled spans: those that the patterns find in a sample of texts, shown
in their plain form and in spellings the patterns don't know.

A span of the network counts if it holds enough digits or the parts of an address (``_holds``) and touches no
span of the patterns. Any such span holds an ``@`` or a digit and has at most ``MOST_ADDED`` characters, so windows
farther than that from every ``@`` and digit decide nothing and are not decoded: the result is the same (tested).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.llm.common import below, col, fresh, with_arrow

# The kinds, in the order that ties are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match never begins inside digits, and saying so keeps long runs of digits from being walked from each one
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)

# A window decides its middle; the margins on both sides are read only. Longer spans than twice the margin
# are rare, and still whole where both windows tag their parts.
WINDOW, MARGIN, CELLS = 96, 24, 6
SAMPLE_TEXTS = 1500
TAGS = (None, *KINDS)
MOST_ADDED = 64  # characters of a span that the network adds
MIDDLE = WINDOW - 2 * MARGIN
_BATCH = 2048

# Classes of characters: each ASCII sign its own, letters and digits by kind.
LETTER, CAPITAL, DIGIT, SPACE, OTHER, PAD = range(6)
_SIGNS = "@.+-()_%/:,;'\"[]{}#*="
AT, CLASSES = 6, 6 + len(_SIGNS)


def _class_table() -> np.ndarray:
    table = np.full(0x110000 + 1, OTHER, np.uint8)
    letters = np.array([chr(c).isalpha() for c in range(0x3000)])
    table[:0x3000][letters] = LETTER
    table[ord("A") : ord("Z") + 1] = CAPITAL
    table[ord("0") : ord("9") + 1] = DIGIT
    table[[9, 10, 11, 12, 13, 32]] = SPACE
    for k, sign in enumerate(_SIGNS):
        table[ord(sign)] = 6 + k
    table[0x110000] = PAD
    return table


_TABLE = _class_table()


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost addresses of mail, not overlapping: names are read backwards from their ``@``, so each once."""
    low = 0
    for m in HOST.finditer(text):
        before = text[low : m.start()]
        name = len(before) - len(before.rstrip(NAME))
        if name:
            yield m.start() - name, m.end()
        low = m.end() if name else m.start() + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The spans of the patterns: start, place of the kind, end; by start, then kind.

    A text without an ``@`` has no address of mail, one without a ``+`` no phone number, so the patterns that
    would walk a long text in vain are not run on it.
    """
    found = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _addresses(text)]
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        d = _digits(m.group()) if m.end() - m.start() >= CARD_DIGITS[0] else ""
        if CARD_DIGITS[0] <= len(d) <= CARD_DIGITS[1] and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_digits(m.group())) <= PHONE_DIGITS[1]:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _holds(kind: int, text: str) -> bool:
    """Whether a text can be a span of that kind, in whatever spelling."""
    if len(text) > MOST_ADDED:
        return False
    if kind == 0:
        name, at, host = text.partition("@")
        return bool(at) and any(c.isalnum() for c in name) and "." in host and host[-1:].isalnum()
    d = _digits(text)
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return CARD_DIGITS[0] <= len(d) <= CARD_DIGITS[1] and luhn(d)
    return PHONE_DIGITS[0] <= len(d) <= PHONE_DIGITS[1] and (text[0] in "+(0")


def squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Reader:
    """One direction of the LSTM: input, forget and output gates and new values."""

    table: np.ndarray  # classes x 4h
    state: np.ndarray  # h x 4h

    def run(self, order: range, codes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        h, n = self.state.shape[0], codes.shape[1]
        out = np.zeros((*codes.shape, h), np.float32)
        now, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for t in order:
            a = squash(self.table[codes[t]] + now @ self.state)
            gate, new = 0.5 + 0.5 * a[:, : 3 * h], a[:, 3 * h :]
            after = gate[:, :h] * new + gate[:, h : 2 * h] * cell
            shown = squash(after)
            if keep is not None:
                keep[t] = (now, cell, a, after, shown)
            cell, now = after, gate[:, 2 * h :] * shown
            out[t] = now
        return out

    def back(self, order: range, codes: np.ndarray, keep: dict, above: np.ndarray) -> list[np.ndarray]:
        h = self.state.shape[0]
        pre = np.zeros((*codes.shape, 4 * h), np.float32)
        d_state = np.zeros_like(self.state)
        later, d_cell = np.zeros_like(above[0]), np.zeros_like(above[0])
        for t in reversed(order):
            now, cell, a, after, shown = keep[t]
            gate, new = 0.5 + 0.5 * a[:, : 3 * h], a[:, 3 * h :]
            d = above[t] + later
            d_cell = d_cell + d * gate[:, 2 * h :] * (1 - np.abs(shown)) ** 2
            d_a = np.concatenate([0.5 * d_cell * new, 0.5 * d_cell * cell, 0.5 * d * shown, d_cell * gate[:, :h]], axis=1)
            pre[t] = d_a * (1 - np.abs(a)) ** 2
            d_state += now.T @ pre[t]
            later = pre[t] @ self.state.T
            d_cell = d_cell * gate[:, h : 2 * h]
        d_table = np.zeros_like(self.table)
        np.add.at(d_table, codes.ravel(), pre.reshape(-1, 4 * h))
        return [d_table, d_state]


@dataclass
class Tagger:
    """The network and the CRF: scores of tags by character, and of a tag after a tag."""

    forwards: Reader
    backwards: Reader
    out: np.ndarray  # 2h x tags
    bias: np.ndarray
    steps: np.ndarray  # tag x next tag

    def parameters(self) -> list[np.ndarray]:
        f, b = self.forwards, self.backwards
        return [f.table, f.state, b.table, b.state, self.out, self.bias, self.steps]

    def scores(self, codes: np.ndarray, keep: tuple[dict, dict] | None = None) -> tuple[np.ndarray, np.ndarray]:
        order = range(len(codes))
        states = np.concatenate([
            self.forwards.run(order, codes, keep and keep[0]),
            self.backwards.run(order[::-1], codes, keep and keep[1])], axis=2)
        return states @ self.out + self.bias, states

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The best tag of every character, by step and window (Viterbi)."""
        scores, _ = self.scores(codes)
        best, came = scores[0], []
        for t in range(1, len(codes)):
            ways = best[:, :, None] + self.steps
            came.append(ways.argmax(axis=1))
            best = ways.max(axis=1) + scores[t]
        tags = np.empty(codes.shape, np.int8)
        tags[-1] = now = best.argmax(axis=1)
        rows = np.arange(codes.shape[1])
        for t in range(len(codes) - 2, -1, -1):
            tags[t] = now = came[t][rows, now]
        return tags

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> list[np.ndarray]:
        """Of the mean negative log-likelihood of the tags, by sums forwards and backwards."""
        keep: tuple[dict, dict] = ({}, {})
        scores, states = self.scores(codes, keep)
        length, n, k = scores.shape

        def total(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

        ahead, behind = [scores[0]], [np.zeros((n, k), np.float32)]
        for t in range(1, length):
            ahead.append(scores[t] + total(ahead[-1][:, :, None] + self.steps, 1))
        for t in range(length - 2, -1, -1):
            behind.append(total(self.steps + (scores[t + 1] + behind[-1])[:, None, :], 2))
        a, b = np.array(ahead), np.array(behind[::-1])
        whole = total(a[-1], 1)
        d = np.exp(a + b - whole[:, None])
        pair = np.exp(a[:-1, :, :, None] + self.steps + (scores[1:] + b[1:])[:, :, None, :] - whole[:, None, None])
        d_steps = pair.sum(axis=(0, 1))
        np.add.at(d_steps, (tags[:-1].ravel(), tags[1:].ravel()), -1)
        t, w = np.indices(tags.shape)
        d[t, w, tags] -= 1
        d /= tags.size
        flat, h = d.reshape(-1, k), self.forwards.state.shape[0]
        above = (flat @ self.out.T).reshape(states.shape)
        order = range(length)
        return [
            *self.forwards.back(order, codes, keep[0], above[:, :, :h]),
            *self.backwards.back(order[::-1], codes, keep[1], above[:, :, h:]),
            states.reshape(-1, 2 * h).T @ flat, flat.sum(axis=0), (d_steps / tags.size).astype(np.float32),
        ]

    def spans(self, texts: list[str], skip: bool = True) -> list[list[tuple[int, int, int]]]:
        """The spans the network finds in each whole text: start, place of the kind, end.

        ``skip``: only windows whose middle is within ``MOST_ADDED`` characters of a mark are decoded.
        """
        out, group, held = [], [], 0
        for text in texts:
            group.append(_windows(text, skip))
            held += len(group[-1][1])
            if held >= _BATCH:
                out += self._group(group)
                group, held = [], 0
        return out + self._group(group)

    def _ways(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """For each window the value of the best way through its middle, by the tag before it and the last in it.

        With the steps of those ways: at each character the tag before, by the tag before the middle and the tag there.
        """
        scores = self.scores(np.ascontiguousarray(windows.T))[0][MARGIN : WINDOW - MARGIN]
        best, came = self.steps + scores[0][:, None, :], []
        for now in scores[1:]:
            ways = best[:, :, :, None] + self.steps
            came.append(ways.argmax(axis=2).astype(np.int8))
            best = ways.max(axis=2) + now[:, None, :]
        return best, came

    def reconciled(self, windows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The tags of the middles of windows, each run of which is decoded as one text (``first``: where one begins).

        The best ways through each middle are found for all windows at once; along the runs they are joined to the best
        path of the whole run. Only windows on that path that hold a span are followed again, so no step of a
        character is kept. What lies before a run has no span.
        """
        n, tags = len(windows), np.zeros((len(windows), MIDDLE), np.int8)
        if not n:
            return tags
        best, plain = [], []
        for k in range(0, n, _BATCH):
            ways, came = self._ways(windows[k : k + _BATCH])
            best.append(ways)
            plain.append(~_traced(came, np.zeros(len(ways), np.int8), np.zeros(len(ways), np.int8)).any(axis=1))
        before, last = _joined(np.concatenate(best), first)
        again = np.flatnonzero((before != 0) | (last != 0) | ~np.concatenate(plain))
        for k in range(0, len(again), _BATCH):
            some = again[k : k + _BATCH]
            tags[some] = _traced(self._ways(windows[some])[1], before[some], last[some])
        return tags

    def _group(self, group: list[tuple[int, np.ndarray, np.ndarray]]) -> list[list[tuple[int, int, int]]]:
        found = [w for _, _, w in group if len(w)]
        windows = np.concatenate(found) if found else np.zeros((0, WINDOW), np.uint8)
        first = [np.diff(starts, prepend=-WINDOW) != MIDDLE for _, starts, _ in group]
        tagged = self.reconciled(windows, np.concatenate(first) if first else np.zeros(0, bool))
        out, at = [], 0
        for length, starts, _ in group:
            tags = np.zeros(-(-length // MIDDLE) * MIDDLE, np.int8)
            tags[starts[:, None] + np.arange(MIDDLE)] = tagged[at : at + len(starts)]
            at += len(starts)
            tags = tags[:length]
            edges = np.flatnonzero(np.diff(tags, prepend=0, append=0))
            out.append([(int(s), int(tags[s]) - 1, int(e)) for s, e in zip(edges, edges[1:]) if tags[s]])
        return out


def _traced(came: list[np.ndarray], before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The tags of each window's middle on the best way between two tags."""
    rows, tags = np.arange(len(last)), np.empty((len(last), len(came) + 1), np.int8)
    tags[:, -1] = now = last
    for t in range(len(came) - 1, -1, -1):
        tags[:, t] = now = came[t][rows, before, now]
    return tags


def _joined(best: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the tag before it and the last in it, on the best path of its run."""
    n, _, kinds = best.shape
    place = np.arange(n) - np.flatnonzero(first)[np.cumsum(first) - 1]
    levels = np.split(np.argsort(place, kind="stable"), np.cumsum(np.bincount(place))[:-1])
    value, came = best[:, 0, :].astype(np.float64), np.zeros((n, kinds), np.int8)
    for now in levels[1:]:
        ways = value[now - 1][:, :, None] + best[now]
        came[now], value[now] = ways.argmax(axis=1), ways.max(axis=1)
        value[now] -= value[now].max(axis=1, keepdims=True)
    last = value.argmax(axis=1).astype(np.int8)
    for now in levels[:0:-1]:
        last[now - 1] = came[now, last[now]]
    return came[np.arange(n), last], last


def _windows(text: str, skip: bool) -> tuple[int, np.ndarray, np.ndarray]:
    """The length of a text, where the middles of its windows start, and the classes in each window."""
    classes = _TABLE[code_points(text)]
    count = -(-len(classes) // MIDDLE)
    padded = np.full(count * MIDDLE + 2 * MARGIN, PAD, np.uint8)
    padded[MARGIN : MARGIN + len(classes)] = classes
    starts = np.arange(count) * MIDDLE
    if skip:
        marks = np.concatenate([[0], np.cumsum((classes == DIGIT) | (classes == AT))])
        low, high = np.maximum(starts - MOST_ADDED, 0), np.minimum(starts + MIDDLE + MOST_ADDED, len(classes))
        starts = starts[marks[high] > marks[np.minimum(low, len(classes))]]
    return len(classes), starts, padded[starts[:, None] + np.arange(WINDOW)]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def find(texts: list[str], tagger: Tagger | None, skip: bool = True) -> list[list[tuple[int, int, int]]]:
    """All spans of each text by start, then kind: those of the patterns, and what the network adds to them."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return base
    marked = [k for k, t in enumerate(texts) if not skip or re.search("[@0-9]", t)]
    for k, spans in zip(marked, tagger.spans([texts[k] for k in marked], skip)):
        base[k] = sorted(base[k] + _added(texts[k], base[k], spans))
    return base


def _added(text: str, base: list[tuple[int, int, int]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans of the network that can be of their kind and touch none of the patterns'."""
    covered = np.zeros(len(text), bool) if spans else None
    for s, _, e in base if spans else ():
        covered[s:e] = True
    added = []
    for s, kind, e in spans:
        while s < e and text[s].isspace():
            s += 1
        while e > s and not text[e - 1].isalnum():
            e -= 1
        if s < e:
            s, e = _whole_words(text, s, kind, e)
        if s < e and not covered[s:e].any() and _holds(kind, text[s:e]):
            added.append((s, kind, e))
    return added


def _whole_words(text: str, start: int, kind: int, end: int) -> tuple[int, int]:
    """A span with all of the words it begins and ends in: of mail the name's characters, else digits.

    Mail that begins with its ``@`` gets the name before it, which may stand apart.
    """
    part = NAME if kind == 0 else "0123456789"
    before, after = text[max(0, start - MOST_ADDED) : start], text[end : end + MOST_ADDED]
    named = before.rstrip(" ") if kind == 0 and text[start] == "@" else before if text[start] in part else ""
    word = len(named) - len(named.rstrip(part))
    low = start - (len(before) - len(named)) - word if word else start
    high = end + len(after) - len(after.lstrip(part)) if text[end - 1] in part else end
    while high > end and not text[high - 1].isalnum():
        high -= 1
    return low, high


def _spelled(rng: np.random.Generator, kind: int, span: str) -> str:
    """The span in its plain form or in a spelling the patterns don't know."""
    way = rng.integers(0, 3)
    if way == 0:
        return span
    d = _digits(span)
    if kind == 0:
        name, _, host = span.partition("@")
        return f"{name} @ {host}" if way == 1 else f"{name}@{host.replace('.', ' . ')}"
    if kind == 1:
        return span.replace(".", " . " if way == 1 else ". ")
    if kind == 2:
        return " / ".join(d[k : k + 4] for k in range(0, len(d), 4)) if way == 1 else ".".join(d[k : k + 4] for k in range(0, len(d), 4))
    return f"({d[1:4]}) {d[4:7]}-{d[7:]}" if way == 1 else f"00{d[:1]} {d[1:4]} {d[4:]}"


def train(
    examples: list[tuple[str, list[tuple[int, int, int]]]], steps: int = 200, batch: int = 64, cells: int = CELLS,
    rate: float = 0.03, seed: int = 11,
) -> Tagger:
    """A tagger fitted by Adam to texts with labelled spans; windows with a span and other windows by halves."""
    rng = np.random.default_rng(seed)
    codes, tags = [], []
    for text, spans in examples:
        shown, marks, at = [], [], 0
        for s, kind, e in spans:
            if s < at:
                continue
            said = _spelled(rng, kind, text[s:e])
            shown += [text[at:s], said]
            marks += [0] * (s - at) + [kind + 1] * len(said)
            at = e
        shown.append(text[at:])
        marks += [0] * (len(text) - at)
        codes.append(np.concatenate([np.full(MARGIN, PAD), _TABLE[code_points("".join(shown))], np.full(WINDOW, PAD)]))
        tags.append(np.concatenate([np.zeros(MARGIN, int), marks, np.zeros(WINDOW, int)]).astype(int))
    holding = [k for k, t in enumerate(tags) if t.any()]
    normal = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    reader = lambda: Reader(normal(CLASSES, 4 * cells), normal(cells, 4 * cells))
    model = Tagger(reader(), reader(), normal(2 * cells, len(TAGS)), np.zeros(len(TAGS), np.float32), normal(len(TAGS), len(TAGS)))
    parameters = model.parameters()
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, steps + 1):
        x, y = [], []
        for b in range(batch):
            k = holding[rng.integers(len(holding))] if holding and b % 2 else int(rng.integers(len(codes)))
            about = rng.choice(np.flatnonzero(tags[k])) - WINDOW // 2 + rng.integers(-30, 30) if b % 2 and tags[k].any() else rng.integers(0, len(codes[k]))
            at = int(np.clip(about, 0, len(codes[k]) - WINDOW))
            x.append(codes[k][at : at + WINDOW])
            y.append(tags[k][at : at + WINDOW])
        gradients = model.gradients(np.array(x).T, np.array(y).T)
        now = rate * min(1, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(parameters, gradients, first, second):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def fit(docs: DataFrame, text_col: str = "text", texts: int = SAMPLE_TEXTS, around: int = 400, seed: int = 0) -> Tagger | None:
    """A tagger learned from a bounded sample: ``texts`` texts with four digits or an ``@``, by the smallest hashes.

    Of each, ``around`` characters before and after the first such place are used, whose spans by the patterns are
    the labels. Such texts are counted first, and only the share of hashes that holds four times the sample leaves
    the scan. The same input gives the same tagger. None where there is nothing to learn from.
    """
    mark = F.lit("[0-9]{4}|@")
    rows = docs.select(col(docs, text_col).alias("text")).filter(F.col("text").rlike("[0-9]{4}|@"))
    count = rows.count()
    if not count:
        return None
    first = F.regexp_instr("text", mark).cast("int")
    part = F.substr("text", F.greatest(F.lit(1), first - around), F.lit(2 * around))
    parts = rows.select(part.alias("part")).withColumn("key", F.xxhash64(F.lit(seed), "part"))
    few = parts.filter(below(F.col("key"), min(1.0, 4.0 * texts / count) + 1e-9))
    sample = few.distinct().orderBy("key", "part").limit(texts)
    found = [r.part for r in sample.collect()]
    return train([(t, base_spans(t)) for t in found]) if found else None


_SPANS = T.ArrayType(T.StructType().add("start", T.IntegerType()).add("kind", T.StringType()).add("end", T.IntegerType()).add("base", T.BooleanType()))


def with_spans(docs: DataFrame, tagger: Tagger | None, into: str = "spans", text_col: str = "text") -> DataFrame:
    """``docs`` with an array ``into`` of start, kind, end (code points, end exclusive) and base (of a pattern).

    By start, then kind in the order of ``KINDS``. Nothing is shuffled; whole texts are read, however long; a null
    or empty text has no spans; repeated rows each get theirs; an empty table stays empty. Other columns stay;
    ``into`` must not be one of them. Without a tagger only the patterns are used.
    """

    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([
            [{"start": s, "kind": KINDS[k], "end": e, "base": b} for s, k, e, b in found]
            for found in _marked(texts.tolist(), tagger)])

    return docs.withColumn(into, F.pandas_udf(spans, _SPANS)(F.coalesce(col(docs, text_col), F.lit(""))))


def _marked(texts: list[str], tagger: Tagger | None) -> list[list[tuple[int, int, int, bool]]]:
    out = []
    for text, spans in zip(texts, find(texts, tagger)):
        base = set(base_spans(text)) if spans else ()
        out.append([(*x, x in base) for x in spans])
    return out


def _redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for s, kind, e in spans:
        if e <= at:
            continue
        out += [text[at : max(s, at)], f"<{KINDS[kind]}>"] if s >= at else []
        at = e
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text replaced by its kind in angle brackets; overlapping spans by the first's.

    Null texts stay null, empty ones empty; repeated rows stay; a very long text is a slice of its own; an empty table
    stays empty. The columns are those of ``docs``.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        given = texts.to_pylist()
        found = find([t or "" for t in given], tagger)
        return [pa.array([None if t is None else _redact(t, s) for t, s in zip(given, found)], pa.string())]

    (clean,) = fresh(docs, "redacted")
    told = with_arrow(docs, text_col, [f"`{clean}` string"], run)
    place = docs.columns.index(text_col)
    kept = [told[f"`{c}`"] if k != place else F.col(clean).alias(text_col) for k, c in enumerate(docs.columns)]
    return told.select(*kept)
