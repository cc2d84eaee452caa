"""Ingest of daily bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import round_half_up
from tickloom.sources.seeds import SYMBOL_UNIVERSE

BAR_FIELDS = ("Open", "High", "Low", "Close", "Volume")


def typical_price(open_: Column, high: Column, low: Column, close: Column) -> Column:
    return round_half_up((open_ + high + low + close) / 4, 4)


def bars_from_wide(
    wide: DataFrame, symbols: Sequence[str], *, date: str = "Date", suffix: str = ""
) -> DataFrame:
    """Wide frame with ``<symbol><suffix>_<field>`` columns to one bar per symbol and day.

    Days without an open are left out, an unknown volume is 0, and the volume
    weighted price, which such sources do not carry, is the mean of the four prices.
    """
    present = set(wide.columns)
    # symbols the source returned nothing for have no columns at all
    found = [s for s in symbols if f"{s}{suffix}_Open" in present]
    per_symbol = F.array(*[
        F.struct(
            F.lit(s).alias("symbol"),
            *[F.col(f"`{s}{suffix}_{f}`").alias(f.lower()) for f in BAR_FIELDS],
        )
        for s in found
    ])
    rows = wide.select(F.col(date).cast("date").alias("_day"), F.inline(per_symbol))
    return rows.filter(F.col("open").isNotNull() & ~F.isnan("open")).select(
        "symbol",
        F.date_format("_day", "yyyy-MM-dd").alias("date"),
        "open", "high", "low", "close",
        F.coalesce(F.col("volume").cast("bigint"), F.lit(0).cast("bigint")).alias("volume"),
        typical_price(F.col("open"), F.col("high"), F.col("low"), F.col("close")).alias("vwap"),
        F.lit(0).cast("bigint").alias("transactions"),
    )


def in_universe(df: DataFrame, symbols: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Rows of the wanted symbols: a list, a table with a ``symbol`` column, or the default list."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol"), "symbol", "left_semi")
    return df.filter(F.col("symbol").isin(list(symbols or SYMBOL_UNIVERSE)))


def quotes_from_bars(bars: DataFrame, spread: float = 0.001) -> DataFrame:
    """A bar as a quote: the close with a symmetric relative spread around it."""
    close = F.col("close")
    return bars.select(
        "symbol", "date",
        round_half_up(close, 4).alias("price"),
        "volume",
        round_half_up(close - close * spread / 2, 4).alias("bid"),
        round_half_up(close + close * spread / 2, 4).alias("ask"),
    )
