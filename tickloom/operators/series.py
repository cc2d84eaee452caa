"""Window columns over ordered series, one series per key.

A series of daily bars has at most one row per calendar day and key, so a
window partition stays small however large the raw data is. For series without
such a bound ``block_rows`` cuts every series into blocks that are windowed
independently.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

Frame = Callable[..., WindowSpec]
Stage = Callable[[Frame], Mapping[str, Column]]
# A series of more rows is cut into blocks; 200,000 rows of all features are some 100 MB.
SERIES_ROWS = 200_000


def frames(keys: Sequence[str], order: str) -> Frame:
    """``over()`` is the ordered window, ``over(n)`` the last ``n`` rows up to the current one."""
    ordered = Window.partitionBy(*keys).orderBy(order)

    def over(rows: int | None = None) -> WindowSpec:
        return ordered if rows is None else ordered.rowsBetween(-(rows - 1), 0)

    return over


def with_series(
    df: DataFrame,
    stages: Sequence[Stage],
    *,
    keys: Sequence[str] = ("symbol",),
    order: str = "date",
    lookback: int = 0,
    block_rows: int | None = None,
    slice_by: str = "year",
) -> DataFrame:
    """Add the columns of each stage; a stage may use the columns of the ones before it.

    All stages share one shuffle and one sort. ``lookback`` is the number of
    preceding rows that decide a row's value over all stages together; it is
    needed only with ``block_rows``. Rows are numbered by ``slice_by``, a unit of
    ``date_trunc``; :func:`series_blocks` chooses both from counted rows.
    """
    if block_rows is None:
        over = frames(keys, order)
        for stage in stages:
            df = df.withColumns(dict(stage(over)))
        return df
    blocks = _into_blocks(df, list(keys), order, lookback, block_rows, slice_by)
    over = frames([*keys, "_block"], order)
    for stage in stages:
        blocks = blocks.withColumns(dict(stage(over)))
    return blocks.filter(~F.col("_is_copy")).drop("_block", "_is_copy")


def _into_blocks(
    df: DataFrame, keys: list[str], order: str, lookback: int, block_rows: int, slice_by: str
) -> DataFrame:
    """Number the rows of each series and assign them to blocks of ``block_rows``.

    The last ``lookback`` rows of a block are copied into the next one. Row
    numbers are found per calendar slice and shifted by the size of the slices
    before, so no task has to see a whole series.
    """
    if block_rows < max(lookback, 1):
        raise ValueError("block_rows must be at least as large as lookback")
    sliced = df.withColumn("_slice", F.date_trunc(slice_by, order))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"))
        .select(*keys, "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"))
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(order)
    position = F.col("_shift") + F.row_number().over(within) - 1
    # null-safe, so that rows without a key or a date stay
    of = {k: f"_of_{k}" for k in (*keys, "_slice")}
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in of.items()]
    numbered = sliced.join(shifts.withColumnsRenamed(of), same).drop(*of.values()).withColumn("_position", position)
    home = F.floor(F.col("_position") / block_rows)
    near_end = F.col("_position") % block_rows >= block_rows - lookback
    targets = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    return (
        numbered.withColumn("_home", home)
        .withColumn("_block", F.explode(targets))
        .withColumn("_is_copy", F.col("_block") != F.col("_home"))
        .drop("_slice", "_shift", "_position", "_home")
    )


def series_blocks(
    df: DataFrame, keys: Sequence[str] = ("symbol",), order: str = "date", most: int = SERIES_ROWS
) -> dict[str, int | str]:
    """Settings for :func:`with_series` by which no task holds more than about ``most`` rows; none if no series is longer.

    Rows are counted in one aggregation by key and hour, whose totals by day, month, year and key are the sizes to choose
    from. Rows are numbered by the longest unit that keeps to ``most``, by the hour if none does. ``most`` has to
    be at least the models' look-back. NULL keys and dates are counted like others.
    """
    units = ["year", "month", "day", "hour"]
    hours = df.groupBy(F.struct(*keys).alias("key"), F.date_trunc("hour", order).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    levels = hours.select("key", "n", *[F.date_trunc(u, "hour").alias(u) for u in units])
    # one total for each prefix of (key, year, month, day, hour), the widest first
    sizes = (
        levels.rollup("key", *units).agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
        .groupBy("level").agg(F.max("n").alias("n"))
    )
    largest = {r.level: r.n for r in sizes.collect()}  # one row a level
    # grouping_id has a bit for each column that is rolled up: the key alone leaves the four units' bits
    if largest.get(0b1111, 0) <= most:
        return {}
    fits = [u for u, left in zip(units, (0b111, 0b11, 0b1, 0b0)) if largest[left] <= most]
    return {"block_rows": most, "slice_by": fits[0] if fits else units[-1]}


def rolling_mean(column: str, over: Frame, rows: int, min_rows: int = 1) -> Column:
    return _from(min_rows, column, F.avg(column).over(over(rows)), over(rows))


def rolling_std(column: str, over: Frame, rows: int, min_rows: int = 1) -> Column:
    """Sample deviation; NULL for a single value."""
    return _from(min_rows, column, F.stddev_samp(column).over(over(rows)), over(rows))


def _from(min_rows: int, column: str, value: Column, window: WindowSpec) -> Column:
    if min_rows <= 1:
        return value
    return F.when(F.count(column).over(window) >= min_rows, value)

