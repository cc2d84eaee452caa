"""Typed, validated and deduplicated inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.dedup import latest_per_key

BAR_TYPES = {
    "symbol": "string", "date": "date", "open": "double", "high": "double", "low": "double",
    "close": "double", "volume": "bigint", "vwap": "double", "transactions": "bigint",
    "ingestion_time": "timestamp",
}

TICK_TYPES = {
    "symbol": "string", "price": "double", "volume": "bigint", "bid": "double", "ask": "double",
    "event_time": "timestamp", "event_date": "date", "session_status": "string",
    "ingestion_time": "timestamp",
}


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The named columns cast to their types; what cannot be read becomes NULL."""
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])


def all_positive(*columns: str) -> Column:
    """True when every column is known and above 0."""
    condition = F.lit(True)
    for column in columns:
        condition = condition & (F.col(column) > 0)
    return condition


def silver_ohlcv(bars: DataFrame) -> DataFrame:
    """One valid bar per symbol and date, the one ingested last."""
    valid = typed(bars, BAR_TYPES).filter(
        F.col("symbol").isNotNull() & F.col("date").isNotNull()
        & all_positive("close", "volume", "open", "high", "low")
    )
    return latest_per_key(valid, ["symbol", "date"], "ingestion_time")


def silver_ticks(ticks: DataFrame) -> DataFrame:
    """One valid tick per symbol and event time, the one ingested last."""
    valid = typed(ticks, TICK_TYPES).filter(
        F.col("symbol").isNotNull() & F.col("event_time").isNotNull()
        & all_positive("price", "volume")
    )
    return latest_per_key(valid, ["symbol", "event_time"], "ingestion_time")
