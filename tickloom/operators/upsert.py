"""Replacing rows of a table by key, window or touched series."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the target's rows with any of the new keys, then add the new rows.

    Columns only one side has are filled with NULL on the other.
    """
    new_keys = rows.select(*keys).distinct()
    kept = target.join(new_keys, list(keys), "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def within(date: Column, start: str, days: int) -> Column:
    first = F.lit(start).cast("date")
    return (date >= first) & (date < F.date_add(first, days))


def replace_window(
    target: DataFrame, source: DataFrame, date: str, start: str, days: int
) -> DataFrame:
    """Target with its rows of ``[start, start + days)`` replaced by the source's."""
    inside = within(F.col(date), start, days)
    kept = target.filter(~inside | F.col(date).isNull())
    return kept.unionByName(source.filter(inside), allowMissingColumns=True)


def newer_than(df: DataFrame, date: str, target: DataFrame) -> DataFrame:
    """Rows above the target's high-water mark, all of them if the target is empty."""
    mark = target.agg(F.max(date)).scalar()
    return df.filter(mark.isNull() | (F.col(date) > mark))


def touched_since(df: DataFrame, stamp: str, target: DataFrame) -> DataFrame:
    """Rows that arrived since the target's last stamp, also those with an old date.

    Rows with exactly that stamp are taken again: part of their delivery may
    have come later, and replacing a row by itself changes nothing.
    """
    mark = target.agg(F.max(stamp)).scalar()
    return df.filter(mark.isNull() | (F.col(stamp) >= mark))


def recompute_touched(
    model: Callable[[DataFrame], DataFrame],
    source: DataFrame,
    touched: DataFrame,
    *,
    lookback: int,
    key: str = "symbol",
    date: str = "date",
) -> DataFrame:
    """The model's rows that may differ once the ``touched`` rows are in ``source``.

    Per key these are all rows from its first touched date on. The model is fed
    with them and the ``lookback`` rows before them, counted in rows as its
    frames are, so the result equals that of a full run.
    """
    first = touched.groupBy(key).agg(F.min(date).alias("_first"))
    scope = source.join(first, key)
    newest_first = Window.partitionBy(key).orderBy(F.col(date).desc())
    before = (
        scope.filter(F.col(date) < F.col("_first"))
        .withColumn("_rn", F.row_number().over(newest_first))
        .filter(F.col("_rn") <= lookback).drop("_rn")
    )
    affected = scope.filter(F.col(date) >= F.col("_first"))
    result = model(before.unionByName(affected).drop("_first"))
    return result.join(first, key).filter(F.col(date) >= F.col("_first")).drop("_first")
