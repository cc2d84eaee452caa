"""Dates and exchange hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The exchange trades Sunday to Thursday, 10:00 to 15:00 inclusive, at UTC+3.
EXCHANGE_ZONE = "Asia/Riyadh"
TRADING_WEEKDAYS = [1, 2, 3, 4, 5]  # dayofweek: 1 is Sunday
OPENS_AT, CLOSES_AT = 10 * 3600, 15 * 3600


def month_of(date: Column) -> Column:
    return F.trunc(date, "month")


def half_year_of(date: Column) -> Column:
    """First day of the half-year, 1 January or 1 July."""
    return F.make_date(
        F.year(date), F.when(F.month(date) < 7, F.lit(1)).otherwise(F.lit(7)), F.lit(1)
    )


def is_session_open(moment: Column) -> Column:
    """Whether a UTC time falls into a trading session."""
    there = F.from_utc_timestamp(moment.cast("timestamp"), EXCHANGE_ZONE)
    second = F.hour(there) * 3600 + F.minute(there) * 60 + F.second(there)
    # the closing second itself belongs to the session only up to its first microsecond
    fraction = F.date_format(there, "SSSSSS").cast("int")
    in_hours = (second >= OPENS_AT) & (
        (second < CLOSES_AT) | ((second == CLOSES_AT) & (fraction == 0))
    )
    return F.dayofweek(there).isin(TRADING_WEEKDAYS) & in_hours


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day from ``start`` to ``end``, both inclusive, for each row of ``bounds``."""
    days = F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("date"))
