"""Forward as-of lookup."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

# Days of a series in one window: a year, of which the next slice's first weeks are copied.
SLICE_DAYS = 366

def with_forward_value(
    events: DataFrame,
    series: DataFrame,
    *,
    value: str,
    windows: Mapping[str, tuple[int, int]],
    dates: bool = False,
    key: str = "symbol",
    date: str = "date",
    slice_days: int = SLICE_DAYS,
) -> DataFrame:
    """For each event the first ``value`` of its series in days ``[date + low, date + high]``.

    ``windows`` names an output column for each ``(low, high)``; no value in range
    gives NULL. With ``dates`` a column ``<name>_date`` tells the day of the value.
    Events and series are put into one ordering by day and read with range frames:
    one shuffle, no join and no candidate rows. A series is cut into slices of ``slice_days``; values
    that events of an earlier slice can reach are copied into it, so a window holds one slice of one key however
    long its history is. An event without a date finds nothing.
    """
    day = F.datediff(date, F.lit("1970-01-01").cast("date"))
    slice_of = lambda d: F.floor(d / slice_days)
    lowest, highest = min(low for low, _ in windows.values()), max(high for _, high in windows.values())
    point = F.struct(F.col(value).alias("value"), F.col(date).cast("date").alias("date"))
    points = series.select(key, date, F.when(F.col(value).isNotNull(), point).alias("_point"))
    marks = events.select(
        key, date, F.lit(None).cast(points.schema["_point"].dataType).alias("_point"),
        F.struct(*events.columns).alias("_event"),
    )
    points = points.withColumns({
        "_event": F.lit(None).cast(marks.schema["_event"].dataType), "_day": day,
    }).withColumn("_slice", F.explode(F.sequence(slice_of(F.col("_day") - highest), slice_of(F.col("_day") - lowest))))
    marks = marks.withColumn("_day", day).withColumn("_slice", slice_of(F.col("_day")))
    order = Window.partitionBy(key, "_slice").orderBy("_day")
    found = {
        f"_at_{name}": F.first("_point", ignorenulls=True).over(order.rangeBetween(low, high))
        for name, (low, high) in windows.items()
    }
    values = [F.col(f"_at_{name}.value").alias(name) for name in windows]
    days = [F.col(f"_at_{name}.date").alias(f"{name}_date") for name in windows] if dates else []
    return (
        points.unionByName(marks).withColumns(found)
        .filter(F.col("_event").isNotNull()).select("_event.*", *values, *days)
    )


def value_range(events: DataFrame, high: int, date: str = "date") -> tuple[dt.date, dt.date] | None:
    """The first day and the last one, ``high`` days on, in which values for the events can lie."""
    first, last = events.agg(F.min(date).cast("date"), F.max(date).cast("date")).first()
    return (first, last + dt.timedelta(days=high)) if first else None


def in_play(
    events: DataFrame, series: DataFrame, high: int, key: str = "symbol", date: str = "date"
) -> DataFrame:
    """The rows of the series that a lookup of the events can reach.

    The days are found first, so that they reach the scan as plain bounds; ``events``
    should be a stored table. The keys are a semi join on the distinct ones.
    """
    days = value_range(events, high, date)
    if days is None:
        return series.filter(F.lit(False))
    near = series.filter(F.col(date).between(F.lit(days[0]), F.lit(days[1])))
    return near.join(events.select(key).distinct(), key, "left_semi")
