"""All per-instrument columns of the signal model in one pass over the bars.

The decision models read one row per symbol and date from four gold tables
that are themselves windows over the same bars. Computed together they need one
shuffle by symbol and one sort, and the joins between them go away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions import numeric as n
from tickloom.operators.series import with_series
from tickloom.plans import decision, gold
from tickloom.session import written

WIDE_COLUMNS = (
    "symbol", "company_name", "sector", "market_cap_tier", "date", "close", "daily_return",
    *gold.VOTES, "signal_score", "buy_signals", "sell_signals", "neutral_signals", "rating",
    "rsi14", "sma50", "sma200", "bb_lower", "bb_upper", "high_52w", "low_52w", "pct_from_high",
    "pct_from_low", "at_52w_high", "at_52w_low", "annualized_vol", "price_outlier",
    "volume_outlier", "down_days_3d",
)

LOOKBACK = max(gold.YEAR_ROWS, max(gold.MEAN_FRAMES)) - 1


def daily_features(bars: DataFrame, symbols: DataFrame, **series: int | str) -> DataFrame:
    """Ratings, levels, volatility, outliers and the down streak, one row per symbol and date."""
    known = gold.with_dimension(bars, symbols, "company_name", "sector", "market_cap_tier").select(
        "symbol", "company_name", "sector", "market_cap_tier", "date",
        "high", "low", "close", "volume",
    )
    lagged = with_series(known, [gold.previous_close], lookback=1, **series)
    moves = gold.with_daily_return(gold.with_log_return(gold.with_gain_and_loss(lagged)))
    stages = [
        lambda over: {
            **gold.momentum_stage(over), **gold.volatility_stage(over), **gold.level_stage(over),
            **gold.outlier_stage(over), **decision.streak_stage(over),
        }
    ]
    rolled = with_series(moves, stages, lookback=LOOKBACK, **series)
    return gold.with_outliers(gold.with_levels(gold.with_volatility(gold.with_rating(rolled))))


def signals_from_bars(
    bars: DataFrame, symbols: DataFrame, rules: DataFrame, **series: int | str
) -> DataFrame:
    """The same rows as ``decision.decision_signals`` over the separate gold tables.

    Only the two figures that span instruments are aggregated and joined back:
    the sector's day and the market's share of price outliers. The wide rows are
    read three times, so they are stored once instead of being computed thrice.
    """
    wide = written(daily_features(bars, symbols, **series).select(*WIDE_COLUMNS), "features")
    sectors = _sector_days(wide)
    market = _market_days(wide)
    certain = decision.with_certainty(wide, rules)
    joined = certain.join(sectors, ["sector", "date"], "left").join(market, "date", "left")
    metaruled = decision.with_metarules(joined)
    inputs = metaruled.withColumns({
        "has_price_anomaly": F.coalesce("price_outlier", F.lit(False)),
        "has_volume_anomaly": F.coalesce("volume_outlier", F.lit(False)),
    })
    return decision.explain_signals(inputs)


def _sector_days(wide: DataFrame) -> DataFrame:
    """Breadth per sector and day; bars are unique per symbol and date, so rows count symbols."""
    r = F.col("daily_return")
    grouped = wide.filter(r.isNotNull()).groupBy("sector", "date").agg(
        F.avg(r).alias("sector_avg_return"),
        (F.count_if(r > 0).cast("double") / F.count(r)).alias("sector_advance_ratio"),
    )
    return grouped.withColumns(n.rounded(sector_avg_return=6))


def _market_days(wide: DataFrame) -> DataFrame:
    """Share of the instruments with a verdict that day whose price verdict is an outlier."""
    judged = F.col("price_outlier").isNotNull() | F.col("volume_outlier").isNotNull()
    return wide.filter(judged).groupBy("date").agg(
        (F.count_if("price_outlier").cast("double") / F.count(F.lit(1))).alias("market_anomaly_rate")
    )
