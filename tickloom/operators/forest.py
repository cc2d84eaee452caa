"""Isolation forest per group, grown and scored apart.

The trees of a group grow from a bounded pool of its rows and become one row of
flat arrays. Every row of the group is then scored in blocks of bounded size, each
with a copy of its group's trees, so a group may hold any number of rows. Spark
forms groups, pools and blocks, normalises the scores and sets the cut; Python
only grows the trees of one pool and follows the rows of one block down them.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

EULER_GAMMA = 0.5772156649015329
# Rows that are followed down the trees at once.
SCORED_AT_ONCE = 4096


def expected_depth(n: np.ndarray) -> np.ndarray:
    """Average path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    many = np.maximum(n, 3.0)
    general = 2.0 * (np.log(many - 1.0) + EULER_GAMMA) - 2.0 * (many - 1.0) / many
    return np.where(n > 2, general, np.where(n == 2, 1.0, 0.0))


def _extremes(slot: np.ndarray, values: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Per slot the smallest and largest value of each feature; empty slots have none."""
    low = np.full((slots, values.shape[1]), np.inf)
    high = np.full((slots, values.shape[1]), -np.inf)
    order = np.argsort(slot, kind="stable")
    sorted_slots, sorted_values = slot[order], values[order]
    starts = np.flatnonzero(np.r_[True, sorted_slots[1:] != sorted_slots[:-1]])
    low[sorted_slots[starts]] = np.minimum.reduceat(sorted_values, starts, axis=0)
    high[sorted_slots[starts]] = np.maximum.reduceat(sorted_values, starts, axis=0)
    return low, high


class Draws(Protocol):
    """What a forest leaves to chance: the rows of each tree, and where a node splits."""

    def rows(self, trees: int, n: int, size: int) -> np.ndarray:
        """``size`` of ``n`` rows for each tree."""

    def splits(
        self, level: int, trees: int, varies: np.ndarray, low: np.ndarray, high: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Per slot of a level the feature and the share of its range below the cut."""


class RandomDraws:
    """Rows, features and cuts at random, always alike for the same seed."""

    def __init__(self, seed: Sequence[int]) -> None:
        self.rng = np.random.default_rng(seed)

    def rows(self, trees: int, n: int, size: int) -> np.ndarray:
        return np.argsort(self.rng.random((trees, n)), axis=1)[:, :size]

    def splits(self, level, trees, varies, low, high):
        pick = np.where(varies, self.rng.random(varies.shape), -1.0).argmax(axis=1)
        return pick, self.rng.random(len(varies))


class HalvingDraws:
    """Nothing at random: the first rows, features in turn, cuts in the middle of a node's range.

    Tree ``t`` begins with feature ``t``; a feature that doesn't vary is passed over. Such trees can be
    written down in SQL, so they show that growing, following and averaging are right.
    """

    def __init__(self, seed: Sequence[int]) -> None:
        pass

    def rows(self, trees: int, n: int, size: int) -> np.ndarray:
        return np.tile(np.arange(size), (trees, 1))

    def splits(self, level, trees, varies, low, high):
        slots, features = varies.shape
        turn = ((np.arange(slots) >> level)[:, None] + level + np.arange(features)) % features
        first = np.take_along_axis(varies, turn, axis=1).argmax(axis=1)
        return turn[np.arange(slots), first], np.full(slots, 0.5)


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees, level by level; the first ``trees`` are the roots.

    ``feature`` is -1 at a leaf. ``value`` is the cut, at a leaf the length of the path that ends there. Rows above the
    cut go to the node after ``left``, others to ``left``. ``place`` numbers a level's nodes from the left, tree by tree.
    """

    trees: int
    size: int
    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    level: np.ndarray
    place: np.ndarray
    held: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Score in (0, 1] for each row of ``x``; higher is easier to isolate."""
        normal = float(expected_depth(np.array([self.size]))[0]) or 1.0
        parts = [self._mean_depth(x[k:k + SCORED_AT_ONCE]) for k in range(0, len(x), SCORED_AT_ONCE)]
        return np.power(2.0, -np.concatenate([np.zeros(0), *parts]) / normal)

    def _mean_depth(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(np.arange(self.trees)[:, None], len(x), axis=1)
        row = np.arange(len(x))
        while (inner := self.feature[at] >= 0).any():
            right = x[row, self.feature[at]] > self.value[at]
            at = np.where(inner, self.left[at] + right, at)
        return self.value[at].mean(axis=0)


def grow(x: np.ndarray, draws: Draws, trees: int, sample: int) -> Forest:
    """A forest from the rows of ``x``, each tree from ``sample`` of them at most."""
    size = min(sample, len(x))
    levels = int(np.ceil(np.log2(max(size, 2))))
    row = draws.rows(trees, len(x), size).ravel()
    slot = np.repeat(np.arange(trees), size)       # tree and position within the level
    there = np.arange(trees)                       # slots that are nodes
    nodes, above = [], 0

    for level in range(levels + 1):
        slots = trees << level
        held = np.bincount(slot, minlength=slots)
        low, high = _extremes(slot, x[row], slots)
        varies = high > low
        splits = varies.any(axis=1) & (held > 1) & (level < levels)
        pick, value = np.full(slots, -1), level + expected_depth(held)
        if splits.any():
            chosen, share = draws.splits(level, trees, varies, low, high)
            every = np.arange(slots)
            bottom = np.where(splits, low[every, chosen], 0.0)
            top = np.where(splits, high[every, chosen], 0.0)
            pick = np.where(splits, chosen, -1)
            value = np.where(splits, bottom + share * (top - bottom), value)
        inner = splits[there]
        above += len(there)
        left = np.where(inner, above + 2 * (np.cumsum(inner) - 1), -1)
        nodes.append((pick[there], value[there], left, np.full(len(there), level), there, held[there]))
        if not inner.any():
            break
        there = (2 * there[inner][:, None] + np.arange(2)).ravel()
        goes_on = splits[slot]
        row, slot = row[goes_on], slot[goes_on]
        slot = 2 * slot + (x[row, pick[slot]] > value[slot])
    return Forest(trees, size, *[np.concatenate(column) for column in zip(*nodes)])


def isolation_scores(x: np.ndarray, seed: Sequence[int], trees: int, sample: int) -> np.ndarray:
    """The scores of rows by a forest grown from them."""
    return grow(x, RandomDraws(seed), trees, sample).scores(x)


# A forest as a row: the number of rows a tree saw, and the nodes.
FOREST_FIELDS = [
    T.StructField("tree_rows", T.IntegerType()),
    T.StructField("trees", T.IntegerType()),
    *[T.StructField(name, T.ArrayType(kind)) for name, kind in {
        "feature": T.ByteType(), "value": T.DoubleType(), "left": T.IntegerType(),
        "level": T.ByteType(), "place": T.IntegerType(), "held": T.IntegerType(),
    }.items()],
]
NODE_ARRAYS = ["feature", "value", "left", "level", "place", "held"]


def _count(group: Sequence[str]) -> Column:
    return F.count(F.lit(1)).over(Window.partitionBy(*group))


def grown_forests(
    df: DataFrame,
    *,
    group: Sequence[str],
    order: str,
    features: Sequence[str],
    min_rows: int = 60,
    trees: int = 100,
    sample: int = 256,
    seed: int = 42,
    pool_rows: int = 4096,
    draws: Callable[[Sequence[int]], Draws] = RandomDraws,
    carried: Sequence[str] = (),
) -> DataFrame:
    """One row of arrays per group of at least ``min_rows`` rows without NULLs: its forest.

    ``carried`` are columns with one value in a group that go along.

    A larger group than ``pool_rows`` is represented by those of its rows with the smallest hashes; trees draw their
    ``sample`` from them. The forest depends on the group's rows and ``seed`` only.
    """
    if pool_rows < max(sample, min_rows):
        raise ValueError("pool_rows must be at least as large as sample and min_rows")
    columns, lead, kept = list(features), list(group), [*group, *carried]
    # features are hashed as well, so that rows alike in the order are told apart
    drawn = F.xxhash64(F.lit(seed), *lead, order, *columns)
    by_hash = Window.partitionBy(*lead).orderBy(drawn, order, *columns)
    pool = (
        df.dropna(subset=columns).select(*kept, order, *columns)
        .withColumn("_drawn", F.row_number().over(by_hash)).filter(F.col("_drawn") <= pool_rows).drop("_drawn")
    )
    schema = T.StructType([*[df.schema[c] for c in kept], *FOREST_FIELDS])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        names = [*kept, *[f.name for f in FOREST_FIELDS]]
        if len(pdf) < min_rows:
            return pd.DataFrame(columns=names)
        pdf = pdf.sort_values([order, *columns], kind="mergesort")
        own = [pdf[c].iloc[0] for c in kept]
        own_seed = [seed, zlib.crc32("|".join(map(str, own[:len(lead)])).encode())]
        forest = grow(pdf[columns].to_numpy(dtype=float), draws(own_seed), trees, sample)
        return pd.DataFrame([[*own, forest.size, trees, *[getattr(forest, a) for a in NODE_ARRAYS]]], columns=names)

    return pool.groupBy(*lead).applyInPandas(fit, schema)


def forest_nodes(forests: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per node: ``tree, level, node, feature, value, held``, ``node`` from the left of its level."""
    nodes = forests.select(*group, F.inline(F.arrays_zip(*[F.col(a) for a in NODE_ARRAYS])))
    width = F.expr("shiftleft(1, CAST(level AS INT))")  # slots of a tree on the node's level
    return nodes.select(
        *group, F.floor(F.col("place") / width).cast("int").alias("tree"), F.col("level").cast("int").alias("level"),
        F.pmod("place", width).cast("long").alias("node"), F.col("feature").cast("int").alias("feature"),
        "value", "held",
    )


def with_isolation_score(
    df: DataFrame,
    *,
    group: Sequence[str],
    order: str,
    features: Sequence[str],
    block_rows: int = 65536,
    **growing: object,
) -> DataFrame:
    """Add ``isolation`` to the rows of each group that has a forest; rows with a NULL feature are left out.

    ``growing`` goes to ``grown_forests``. Rows of a group are scored in blocks of about ``block_rows`` by their
    hashes, whole groups that are no larger in one; the blocks don't change the scores.
    """
    columns, lead = list(features), list(group)
    # counted in the partitioning that the pools need as well, so the input is shuffled by group once
    counted = df.dropna(subset=columns).withColumn("_blocks", F.ceil(_count(lead) / block_rows).cast("int"))
    forests = grown_forests(
        counted, group=group, order=order, features=features, carried=["_blocks"], **growing)
    copies = forests.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")
    hashed = F.xxhash64(*lead, order, *columns)
    placed = counted.withColumn("_block", F.pmod(hashed, F.col("_blocks")).cast("int")).drop("_blocks")
    schema = T.StructType([*df.schema.fields, T.StructField("isolation", T.DoubleType())])

    def score(rows: pd.DataFrame, grown: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="_block")
        if rows.empty or grown.empty:
            return rows.iloc[:0].assign(isolation=np.array([], dtype=float))
        one = grown.iloc[0]
        forest = Forest(int(one["trees"]), int(one["tree_rows"]), *[np.asarray(one[a]) for a in NODE_ARRAYS])
        return rows.assign(isolation=forest.scores(rows[columns].to_numpy(dtype=float)))

    keys = [*lead, "_block"]
    return placed.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(score, schema)
