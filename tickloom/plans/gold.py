"""Indicators per instrument, session and sector.

Each model is the same three steps: window columns over the series, derived
columns, projection. The window columns are kept in stage functions, so that
``features.daily_features`` can compute those of all models in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import labels, numeric as n
from tickloom.operators.series import Frame, rolling_mean, rolling_std, with_series

# Frame lengths and limits of the indicators.
VOLATILITY_FRAMES = (5, 10, 20)
MEAN_FRAMES = (10, 12, 20, 26, 50, 200)
RSI_ROWS, BAND_ROWS, VOLUME_ROWS = 14, 20, 20
YEAR_ROWS = 252
NEAR_LEVEL = 0.02
Z_ROWS, Z_LIMIT = 30, 2.5
FENCE_ROWS, FENCE_WIDTH = 90, 1.5
RSI_LOW, RSI_HIGH = 30, 70

VOTES = (
    "sig_price_sma10", "sig_price_sma20", "sig_price_sma50", "sig_price_sma200",
    "sig_ma_cross", "sig_rsi", "sig_bb", "sig_macd_proxy",
)


def with_dimension(facts: DataFrame, symbols: DataFrame, *columns: str) -> DataFrame:
    """Facts with columns of the symbol dimension; symbols it does not know are dropped.

    No broadcast hint: Spark broadcasts the dimension by its measured size.
    """
    return facts.join(symbols.select("symbol", *columns), "symbol")


# --- window stages -----------------------------------------------------------------------


def previous_close(over: Frame) -> dict[str, Column]:
    return {"prev_close": F.lag("close").over(over())}


def momentum_stage(over: Frame) -> dict[str, Column]:
    means = {f"mean{rows}": rolling_mean("close", over, rows) for rows in MEAN_FRAMES}
    return {
        **means,
        "deviation20": rolling_std("close", over, BAND_ROWS),
        "avg_gain": rolling_mean("gain", over, RSI_ROWS),
        "avg_loss": rolling_mean("loss", over, RSI_ROWS),
        "mean_volume": rolling_mean("volume", over, VOLUME_ROWS),
    }


def volatility_stage(over: Frame) -> dict[str, Column]:
    return {f"sigma{rows}": rolling_std("raw_return", over, rows) for rows in VOLATILITY_FRAMES}


def level_stage(over: Frame) -> dict[str, Column]:
    return {
        "year_high": F.max("high").over(over(YEAR_ROWS)),
        "year_low": F.min("low").over(over(YEAR_ROWS)),
    }


def outlier_stage(over: Frame) -> dict[str, Column]:
    return {
        "volume_mean": rolling_mean("volume", over, Z_ROWS),
        "volume_std": rolling_std("volume", over, Z_ROWS),
        "past_returns": F.collect_list("log_return").over(over(FENCE_ROWS)),
    }


# --- derived columns ---------------------------------------------------------------------


def with_gain_and_loss(df: DataFrame) -> DataFrame:
    change = F.col("close") - F.col("prev_close")
    zero = F.lit(0.0)
    return df.withColumns({
        "gain": F.greatest(F.coalesce(change, zero), zero),
        "loss": F.greatest(F.coalesce(-change, zero), zero),
    })


def with_log_return(df: DataFrame) -> DataFrame:
    """The full-precision return for the deviations, the rounded one for everything else."""
    raw = df.withColumn("raw_return", n.log_return(F.col("close"), F.col("prev_close")))
    return raw.withColumn("log_return", n.round_half_up(F.col("raw_return"), 6))


def with_daily_return(df: DataFrame) -> DataFrame:
    raw = df.withColumn("daily_return", n.pct_change(F.col("close"), F.col("prev_close")))
    return raw.withColumns(n.rounded(daily_return=6))


def with_rating(df: DataFrame) -> DataFrame:
    """Indicators, the eight votes, their sum and its label."""
    c = F.col
    lower, upper = n.band(c("mean20"), c("deviation20"))
    rsi = n.relative_strength(c("avg_gain"), c("avg_loss"))
    indicators = df.withColumns({"lower": lower, "upper": upper, "rsi14": rsi})
    indicators = indicators.withColumns(n.rounded(rsi14=2))

    def compare(left: str, right: str) -> Column:
        return n.vote(n.above(c(left), c(right)), n.below(c(left), c(right)))

    votes = {
        "sig_price_sma10": compare("close", "mean10"),
        "sig_price_sma20": compare("close", "mean20"),
        "sig_price_sma50": compare("close", "mean50"),
        "sig_price_sma200": compare("close", "mean200"),
        "sig_ma_cross": compare("mean10", "mean20"),
        "sig_rsi": n.vote(c("rsi14") < RSI_LOW, c("rsi14") > RSI_HIGH),
        "sig_bb": n.vote(n.below(c("close"), c("lower")), n.above(c("close"), c("upper"))),
        "sig_macd_proxy": compare("mean12", "mean26"),
    }
    voted = indicators.withColumns(votes)
    scored = voted.withColumns({
        "signal_score": n.total([c(v) for v in VOTES]),
        "buy_signals": n.count_true([c(v) == 1 for v in VOTES]),
        "sell_signals": n.count_true([c(v) == -1 for v in VOTES]),
    })
    return scored.withColumns({
        "neutral_signals": len(VOTES) - c("buy_signals") - c("sell_signals"),
        "rating": labels.rating(c("signal_score")),
        "sma10": n.round_half_up(c("mean10"), 2),
        "sma20": n.round_half_up(c("mean20"), 2),
        "sma50": n.round_half_up(c("mean50"), 2),
        "sma200": n.round_half_up(c("mean200"), 2),
        "bb_lower": n.round_half_up(c("lower"), 2),
        "bb_upper": n.round_half_up(c("upper"), 2),
        "avg_volume_20d": n.round_half_up(c("mean_volume"), 0),
    })


def with_volatility(df: DataFrame) -> DataFrame:
    five, ten, twenty = (F.col(f"sigma{rows}") for rows in VOLATILITY_FRAMES)
    return df.withColumns({
        "vol_5d": n.round_half_up(five, 6),
        "vol_10d": n.round_half_up(ten, 6),
        "vol_20d": n.round_half_up(twenty, 6),
        "annualized_vol_5d": n.round_half_up(n.annualized(five), 4),
        "annualized_vol_10d": n.round_half_up(n.annualized(ten), 4),
        "annualized_vol": n.round_half_up(n.annualized(twenty), 4),
    })


def with_levels(df: DataFrame) -> DataFrame:
    """Distance from the year's extremes; nearness is decided before rounding."""
    high, low, close = F.col("year_high"), F.col("year_low"), F.col("close")
    distances = df.withColumns({
        "pct_from_high": n.ratio(close - high, high),
        "pct_from_low": n.ratio(close - low, low),
    })
    return distances.withColumns({
        "at_52w_high": F.col("pct_from_high") > -NEAR_LEVEL,
        "at_52w_low": F.col("pct_from_low") < NEAR_LEVEL,
        "high_52w": n.round_half_up(high, 4),
        "low_52w": n.round_half_up(low, 4),
        **n.rounded(pct_from_high=4, pct_from_low=4),
    })


def with_outliers(df: DataFrame) -> DataFrame:
    """Volume z-score and the distance of the return from its Tukey fences."""
    c = F.col
    z = (c("volume") - c("volume_mean")) / c("volume_std")
    quartiles = df.withColumns({
        "z": F.when(c("volume_std") > 0, z).when(c("volume_std").isNotNull(), F.lit(0.0)),
        "quartiles": n.quantiles(c("past_returns"), 0.25, 0.75),
    }).withColumns({
        "q1": F.get("quartiles", F.lit(0)),
        "q3": F.get("quartiles", F.lit(1)),
    })
    spread = c("q3") - c("q1")
    fences = quartiles.withColumns({
        "spread": spread,
        "low_fence": c("q1") - FENCE_WIDTH * spread,
        "high_fence": c("q3") + FENCE_WIDTH * spread,
    })
    known = c("log_return").isNotNull()  # then the frame has at least this value
    overshoot = F.greatest(
        c("low_fence") - c("log_return"), c("log_return") - c("high_fence"), F.lit(0.0)
    )
    outside = n.below(c("log_return"), c("low_fence")) | n.above(c("log_return"), c("high_fence"))
    return fences.withColumns({
        "volume_score": n.round_half_up(c("z"), 4),
        "volume_outlier": F.abs("z") > Z_LIMIT,
        "price_score": n.round_half_up(
            F.when(known & (c("spread") > n.MARGIN), overshoot / c("spread")), 4
        ),
        "price_outlier": F.when(known, outside),
    })


# --- models ------------------------------------------------------------------------------


def daily_return(bars: DataFrame, symbols: DataFrame, **series: int | str) -> DataFrame:
    """Return against the bar before; a symbol's first bar is left out."""
    known = with_dimension(bars, symbols, "sector", "market_cap_tier")
    returns = with_daily_return(with_series(known, [previous_close], lookback=1, **series))
    return returns.filter(F.col("daily_return").isNotNull()).select(
        "symbol", "date", "close", "volume", "sector", "market_cap_tier", "daily_return"
    )


def sector_performance(returns: DataFrame) -> DataFrame:
    """Breadth and return of each sector and day, from :func:`daily_return`."""
    r = F.col("daily_return")
    grouped = returns.groupBy("sector", "date").agg(
        F.count_distinct("symbol").alias("symbol_count"),
        F.avg(r).alias("avg_daily_return"),
        F.max(r).alias("max_daily_return"),
        F.min(r).alias("min_daily_return"),
        F.stddev_samp(r).alias("stddev_daily_return"),
        F.sum("volume").alias("total_sector_volume"),
        F.count_if(r > 0).alias("advancing"),
    )
    share = F.col("advancing").cast("double") / F.col("symbol_count")
    return grouped.withColumn("advance_ratio", share).drop("advancing").withColumns(
        n.rounded(avg_daily_return=6, max_daily_return=6, min_daily_return=6, stddev_daily_return=6)
    )


def intraday_vwap(ticks: DataFrame, symbols: DataFrame) -> DataFrame:
    """Session summary of each symbol from its ticks.

    The dimension is joined to the sessions, after the ticks were aggregated.
    """
    price, volume = F.col("price"), F.col("volume")
    sessions = ticks.groupBy("symbol", F.col("event_date").alias("session_date")).agg(
        F.sum(price * volume).alias("turnover"),
        F.min_by("price", "event_time").alias("session_open"),
        F.max(price).alias("session_high"),
        F.min(price).alias("session_low"),
        F.max_by("price", "event_time").alias("session_close"),
        F.sum(volume).alias("total_volume"),
        F.count(F.lit(1)).alias("tick_count"),
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("session_end"),
    )
    weighted = n.ratio(F.col("turnover"), F.col("total_volume").cast("double"))
    known = with_dimension(sessions, symbols, "company_name", "sector", "market_cap_tier")
    return known.withColumn("vwap", weighted).drop("turnover").withColumns(
        n.rounded(vwap=4, session_open=4, session_high=4, session_low=4, session_close=4)
    )


def volatility_index(bars: DataFrame, symbols: DataFrame, **series: int | str) -> DataFrame:
    known = with_dimension(bars, symbols, "sector", "company_name")
    lagged = with_log_return(with_series(known, [previous_close], lookback=1, **series))
    # the lag costs one row of context, which the first stage has used up
    rolled = with_series(lagged, [volatility_stage], lookback=max(VOLATILITY_FRAMES) - 1, **series)
    return with_volatility(rolled).select(
        "symbol", "company_name", "sector", "date", "close", "volume", "high", "low",
        "log_return", "vol_5d", "vol_10d", "vol_20d",
        "annualized_vol_5d", "annualized_vol_10d", "annualized_vol",
    )


def levels_52w(bars: DataFrame, symbols: DataFrame, **series: int | str) -> DataFrame:
    known = with_dimension(bars, symbols, "company_name", "sector", "market_cap_tier")
    rolled = with_series(known, [level_stage], lookback=YEAR_ROWS - 1, **series)
    return with_levels(rolled).select(
        "symbol", "company_name", "sector", "market_cap_tier", "date",
        "open", "high", "low", "close", "volume", "high_52w", "low_52w",
        "pct_from_high", "pct_from_low", "at_52w_high", "at_52w_low",
    )


RATING_COLUMNS = (
    "avg_volume_20d", "sma10", "sma20", "sma50", "sma200", "bb_lower", "bb_upper", "rsi14",
    *VOTES, "buy_signals", "sell_signals", "neutral_signals", "signal_score", "rating",
)


def technical_rating(bars: DataFrame, symbols: DataFrame, **series: int | str) -> DataFrame:
    """Eight indicator votes per symbol and day, and the rating their sum stands for."""
    known = with_dimension(bars, symbols, "company_name", "sector", "market_cap_tier")
    moves = with_gain_and_loss(with_series(known, [previous_close], lookback=1, **series))
    rolled = with_series(moves, [momentum_stage], lookback=max(MEAN_FRAMES) - 1, **series)
    return with_rating(rolled).select(
        "symbol", "company_name", "sector", "market_cap_tier", "date", "close", "volume",
        *RATING_COLUMNS,
    )


def _scored(volatility: DataFrame, **series: int | str) -> DataFrame:
    narrow = volatility.select("symbol", "date", "volume", "log_return")
    return with_outliers(with_series(narrow, [outlier_stage], lookback=FENCE_ROWS - 1, **series))


def _verdict(kind: str) -> Column:
    """The detector's verdict on a row, NULL where its frame is too short for one."""
    if kind == "volume_zscore":
        judged, score, limit, outlier = "volume_std", "volume_score", Z_LIMIT, "volume_outlier"
    else:
        judged, score, limit, outlier = "log_return", "price_score", FENCE_WIDTH, "price_outlier"
    return F.when(F.col(judged).isNotNull(), F.struct(
        F.lit(kind).alias("anomaly_type"), F.col(score).alias("score"),
        F.lit(limit).alias("threshold"), F.col(outlier).alias("is_anomaly"),
    ))


def long_flags(scored: DataFrame, *kinds: str) -> DataFrame:
    """One row per detector that has a verdict, all detectors read from the same windows."""
    verdicts = F.array_compact(F.array(*[_verdict(kind) for kind in kinds]))
    return scored.select("symbol", "date", F.inline(verdicts))


def volume_zscore(volatility: DataFrame, **series: int | str) -> DataFrame:
    """Volume against the mean and deviation of its last 30 bars."""
    return long_flags(_scored(volatility, **series), "volume_zscore")


def price_iqr(volatility: DataFrame, **series: int | str) -> DataFrame:
    """Return against the Tukey fences of its last 90 bars."""
    return long_flags(_scored(volatility, **series), "price_iqr")


def anomaly_flags(volatility: DataFrame, **series: int | str) -> DataFrame:
    """Both detectors as one long table."""
    return long_flags(_scored(volatility, **series), "volume_zscore", "price_iqr")


def anomaly_pivot(flags: DataFrame) -> DataFrame:
    """Long flags to one boolean per detector."""

    def fired(kind: str) -> Column:
        return F.bool_or((F.col("anomaly_type") == kind) & F.col("is_anomaly"))

    return flags.groupBy("symbol", "date").agg(
        fired("price_iqr").alias("has_price_anomaly"),
        fired("volume_zscore").alias("has_volume_anomaly"),
    )

