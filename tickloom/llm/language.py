"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are read in windows of ``span`` bytes, each once forwards and once backwards. Every byte
is labelled with a probability for each language, and a text's probabilities are the means over all its bytes.
The network is trained in numpy by backpropagation through time. Both squashing functions are built on
x / (1 + |x|), which costs a tenth of exp.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from tickloom.llm.common import below, col, fresh

UNKNOWN = "und"
SPAN, TRAIN_SPAN, CELLS = 128, 64, 8
# The bounds of the training sample: texts of each language, and windows of each text.
SAMPLE_TEXTS, SAMPLE_WINDOWS = 300, 8
_WINDOWS = 2048


def squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Direction:
    """Weights of one reading direction: per byte, update and reset and new state; and from the state."""

    table: np.ndarray  # 256 x 3h
    gates: np.ndarray  # h x 2h
    state: np.ndarray  # h x h

    def run(self, steps: Iterable[int], codes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """The states at every byte; codes are bytes by step and window."""
        n, h = codes.shape[1], self.state.shape[0]
        out = np.empty((*codes.shape, h), np.float32)
        at, now = np.empty((n, 3 * h), np.float32), np.zeros((n, h), np.float32)
        for t in steps:
            np.take(self.table, codes[t], axis=0, out=at, mode="clip")
            gate = at[:, : 2 * h] + now @ self.gates
            gate /= np.abs(gate) + 1
            gate *= 0.5
            gate += 0.5
            own = now @ self.state
            new = gate[:, h:] * own
            new += at[:, 2 * h :]
            new /= np.abs(new) + 1
            after = now - new
            after *= gate[:, :h]
            after += new
            if keep is not None:
                keep[t] = (now, gate, own, new)
            out[t] = now = after
        return out

    def back(self, steps: Iterable[int], codes: np.ndarray, keep: dict, above: np.ndarray) -> list[np.ndarray]:
        """Gradients of table, gates and state, given those of the states."""
        h = self.state.shape[0]
        pre = np.empty((*codes.shape, 3 * h), np.float32)
        d_gates, d_state = np.zeros_like(self.gates), np.zeros_like(self.state)
        later = np.zeros((codes.shape[1], h), np.float32)
        for t in reversed(list(steps)):
            now, gate, own, new = keep[t]
            d = above[t] + later
            update, reset = gate[:, :h], gate[:, h:]
            d_new = d * (1 - update) * (1 - np.abs(new)) ** 2
            d_gate = np.concatenate([d * (now - new), d_new * own], axis=1) * (0.5 * (1 - np.abs(2 * gate - 1)) ** 2)
            d_own = d_new * reset
            pre[t, :, : 2 * h], pre[t, :, 2 * h :] = d_gate, d_new
            d_gates += now.T @ d_gate
            d_state += now.T @ d_own
            later = d * update + d_gate @ self.gates.T + d_own @ self.state.T
        d_table = np.zeros_like(self.table)
        np.add.at(d_table, codes.ravel(), pre.reshape(-1, 3 * h))
        return [d_table, d_gates, d_state]


@dataclass
class Model:
    """The two directions, the output weights and the languages in order."""

    forwards: Direction
    backwards: Direction
    out: np.ndarray  # 2h x languages
    bias: np.ndarray
    languages: list[str]
    span: int = SPAN

    def parameters(self) -> list[np.ndarray]:
        f, b = self.forwards, self.backwards
        return [f.table, f.gates, f.state, b.table, b.gates, b.state, self.out, self.bias]

    def labels(self, codes: np.ndarray, keep: tuple[dict, dict] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The probability of each language at every byte, and the states they come from."""
        steps = range(len(codes))
        there = self.forwards.run(steps, codes, keep and keep[0])
        back = self.backwards.run(reversed(steps), codes, keep and keep[1])
        h = there.shape[2]
        logits = there.reshape(-1, h) @ self.out[:h]
        logits += back.reshape(-1, h) @ self.out[h:]
        logits += self.bias
        p = np.exp(np.clip(logits, -30, 30, out=logits), out=logits)
        p /= p.sum(axis=1, keepdims=True)
        return p.reshape(*codes.shape, -1), np.concatenate([there, back], axis=2) if keep else there

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """A row of probabilities for each text, the mean over all its bytes; zeros for an empty text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts) + bytes(self.span), np.uint8)
        counts = -(-sizes // self.span)
        owner = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = (np.cumsum(sizes) - sizes)[owner] + place * self.span
        left = np.minimum(sizes[owner] - place * self.span, self.span)
        sums = np.zeros((len(texts), len(self.languages)))
        for k in range(0, len(owner), _WINDOWS):
            some = slice(k, k + _WINDOWS)
            codes = data[first[some] + np.arange(self.span)[:, None]]
            valid = np.arange(self.span)[:, None] < left[some]
            p, _ = self.labels(np.where(valid, codes, 0))
            pooled = np.einsum("tbc,tb->bc", p, valid.astype(np.float32))
            np.add.at(sums, owner[some], pooled.astype(np.float64))
        return sums / np.maximum(sizes, 1)[:, None]

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest language of each text and its score."""
        p = self.probabilities(texts)
        return np.array(self.languages, object)[p.argmax(axis=1)], np.clip(p.max(axis=1), 0, 1).round(6)


def train(
    windows: list[bytes], labels: list[str], span: int = TRAIN_SPAN, cells: int = CELLS, steps: int = 200,
    batch: int = 192, rate: float = 0.02, seed: int = 7,
) -> Model:
    """A model fitted to labelled windows by Adam on the mean cross-entropy of all bytes; languages are drawn evenly."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    normal = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    direction = lambda: Direction(normal(256, 3 * cells), normal(cells, 2 * cells), normal(cells, cells))
    model = Model(direction(), direction(), normal(2 * cells, len(languages)), np.zeros(len(languages), np.float32), languages)
    codes = np.zeros((len(windows), span), np.uint8)
    sizes = np.zeros(len(windows), np.int64)
    for k, w in enumerate(windows):
        codes[k, : len(w[:span])], sizes[k] = np.frombuffer(w[:span], np.uint8), len(w[:span])
    target = np.array([languages.index(x) for x in labels])
    of = [np.flatnonzero(target == c) for c in range(len(languages))]
    parameters = model.parameters()
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, steps + 1):
        pick = np.array([rng.choice(of[c]) for c in rng.integers(0, len(languages), batch)])
        x, y = np.ascontiguousarray(codes[pick].T), target[pick]
        keep: tuple[dict, dict] = ({}, {})
        p, states = model.labels(x, keep)
        valid = np.arange(span)[:, None] < sizes[pick]
        d = p.copy()
        d[:, np.arange(batch), y] -= 1
        d *= (valid / max(1, valid.sum()))[:, :, None].astype(np.float32)
        flat, own = d.reshape(-1, d.shape[2]), states.reshape(-1, states.shape[2])
        above = (flat @ model.out.T).reshape(states.shape)
        order = range(span)
        gradients = [
            *model.forwards.back(order, x, keep[0], above[:, :, :cells]),
            *model.backwards.back(reversed(order), x, keep[1], above[:, :, cells:]),
            own.T @ flat, flat.sum(axis=0),
        ]
        now = rate * min(1, 2 * (1 - step / (steps + 1)))
        for q, g, m, v in zip(parameters, gradients, first, second):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    texts: int = SAMPLE_TEXTS, windows: int = SAMPLE_WINDOWS, span: int = TRAIN_SPAN, seed: int = 0,
) -> list[tuple[str, int, int, str]]:
    """Language, key of the text, number and text of windows of the rows with a language and a letter in the text.

    The sample is bounded whatever the input: of each language up to ``texts`` texts with the smallest hashes of id
    and text, of each text its beginning and ``windows`` - 1 windows at places given by a hash. So a language's share
    of the rows plays no part, a hot source neither, and equal input gives an equal model. Languages are counted
    first; of each only the share of hashes that holds twice the sample leaves the scan.
    """
    text, lang = col(docs, text_col), col(docs, lang_col).cast("string")
    # one row per language; the labels are the classes of the model
    counts = {r.lang: r.n for r in docs.groupBy(lang.alias("lang")).agg(F.count("*").alias("n")).collect() if r.lang is not None}
    if not counts:
        return []
    key = F.xxhash64(F.lit(seed), col(docs, id_col), text)
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2.0 * texts / n) + 1e-9)])
    few = docs.select(lang.alias("lang"), text.alias("text"), key.alias("key")).filter(
        F.col("lang").isNotNull() & below(F.col("key"), F.element_at(shares, F.col("lang"))) & F.col("text").rlike(r"\p{L}"))
    place = lambda k: F.lit(1) if k == 0 else (
        F.pmod(F.xxhash64("key", F.lit(k)), F.greatest(F.lit(1), F.char_length("text") - span)) + 1).cast("int")
    # only the windows are moved, not the texts
    cut = few.select("lang", "key", F.array(*[F.substr("text", place(k), F.lit(span)) for k in range(windows)]).alias("w"))
    rows = cut.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("key", "w"))).filter(F.col("n") <= texts)
    return sorted((r.lang, r.key, k, w) for r in rows.collect() for k, w in enumerate(r.w))


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    texts: int = SAMPLE_TEXTS, windows: int = SAMPLE_WINDOWS, span: int = TRAIN_SPAN, seed: int = 0,
) -> Model | None:
    """A model for the languages of ``docs``, learned from their :func:`sample`; None where it is empty."""
    return fit_sample(sample(docs, id_col, text_col, lang_col, texts, windows, span, seed))


def fit_sample(found: list[tuple[str, int, int, str]]) -> Model | None:
    return train([w.encode() for *_, w in found], [lang for lang, *_ in found]) if found else None


def with_language(docs: DataFrame, model: Model | None, into: str = "language", text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``into``: lang_pred and score, from the whole text alone.

    ``score`` is the pooled probability of the language, from 0 to 1. A text that is null, empty or has no letter
    is ``und`` with score 0, as are all texts without a model. Nothing is shuffled; texts of any length are read window by window; equal texts get equal
    results; an empty table stays empty. Other columns stay; ``into`` must not be one of them.
    """
    nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return docs.withColumn(into, nothing)

    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = model.predict([t.encode("utf-8", "replace") if t else b"" for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    kind = T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType())
    (raw,) = fresh(docs, "predicted")
    text = col(docs, text_col)
    known = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    # a text without a letter is passed as empty
    given = docs.withColumn(raw, F.pandas_udf(predict, kind)(F.when(known, text)))
    return given.withColumn(into, F.when(known, F.col(raw)).otherwise(nothing)).drop(raw)
