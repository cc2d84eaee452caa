"""Numbers and values to labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Label thresholds, each list in the order it is tested.
RATING_CUTS = [(5, "Strong Buy"), (3, "Buy"), (-2, "Neutral"), (-4, "Sell")]
RATING_LAST = "Strong Sell"
CONFIDENCE_CUTS = [(0.65, "HIGH"), (0.40, "MEDIUM")]
CONFIDENCE_LAST = "LOW"
SCORE_BIN_CUTS = [(5, "strong_buy"), (3, "buy"), (-2, "neutral"), (-4, "sell")]
SCORE_BIN_LAST = "strong_sell"
VOLATILITY_BIN_CUTS = [(0.20, "very_low"), (0.35, "low"), (0.50, "medium"), (0.70, "high")]
VOLATILITY_BIN_LAST = "very_high"
POSITION_BIN_CUTS = [(-0.50, "near_low"), (-0.30, "mid_low"), (-0.15, "mid"), (-0.05, "mid_high")]
POSITION_BIN_LAST = "near_high"


def label_at_least(value: Column, cuts: Sequence[tuple[float, str]], last: str) -> Column:
    """Label of the first cut the value reaches."""
    chain = F
    for cut, label in cuts:
        chain = chain.when(value >= cut, F.lit(label))
    return chain.otherwise(F.lit(last))


def label_below(value: Column, cuts: Sequence[tuple[float, str]], last: str) -> Column:
    """Label of the first cut the value stays under."""
    chain = F
    for cut, label in cuts:
        chain = chain.when(value < cut, F.lit(label))
    return chain.otherwise(F.lit(last))


def by_value(value: Column, results: Mapping[str, Column], otherwise: Column) -> Column:
    """``CASE value WHEN .. THEN .. ELSE .. END``."""
    chain = F
    for key, result in results.items():
        chain = chain.when(value == F.lit(key), result)
    return chain.otherwise(otherwise)


def rating(score: Column) -> Column:
    return label_at_least(score, RATING_CUTS, RATING_LAST)


def confidence(certainty: Column) -> Column:
    return label_at_least(F.abs(certainty), CONFIDENCE_CUTS, CONFIDENCE_LAST)


def score_bin(score: Column) -> Column:
    return label_at_least(score, SCORE_BIN_CUTS, SCORE_BIN_LAST)


def volatility_bin(volatility: Column) -> Column:
    return label_below(F.coalesce(volatility, F.lit(0.0)), VOLATILITY_BIN_CUTS, VOLATILITY_BIN_LAST)


def position_bin(pct_from_high: Column) -> Column:
    # an unknown position reaches no cut and lands in the last bin
    return label_below(pct_from_high, POSITION_BIN_CUTS, POSITION_BIN_LAST)


def rsi_bin(rsi: Column) -> Column:
    known = F.coalesce(rsi, F.lit(50.0))
    return (
        F.when(known < 30, F.lit("oversold")).when(known > 70, F.lit("overbought"))
        .otherwise(F.lit("neutral"))
    )


def sector_bin(advance_ratio: Column) -> Column:
    known = F.coalesce(advance_ratio, F.lit(0.5))
    return (
        F.when(known >= 0.60, F.lit("bullish")).when(known < 0.40, F.lit("bearish"))
        .otherwise(F.lit("neutral"))
    )
