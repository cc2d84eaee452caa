"""Certainty, metarules, signals with their explanations, and the case library."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import dates, labels, numeric as n, text
from tickloom.operators.asof import in_play, with_forward_value
from tickloom.operators.quality import against_decision_table
from tickloom.operators.series import Frame, with_series
from tickloom.operators.similarity import daily_totals, monthly_totals, similar_totals, similar_totals_known
from tickloom.plans.gold import VOTES, anomaly_pivot

# Rule ids in the order their evidence is combined, with the factor used
# when the rule base lacks the rule.
RULE_FACTORS = {
    "R01": 0.30, "R02": 0.40, "R03": 0.50, "R04": 0.60,
    "R05": 0.50, "R06": 0.70, "R07": 0.60, "R08": 0.40,
}

# Gates and metarules.
STRENGTH_LIMIT = 0.40
MARKET_ANOMALY_LIMIT = 0.30
SCORE_NEEDED, SCORE_NEEDED_TIGHT = 3, 6
DOWN_DAY, DOWN_ROWS = -0.02, 3
VOLATILITY_LIMIT = 0.80
ADVANCE_LIMIT = 0.5
HIGH_VOLATILITY_NOTE = 0.5
BUY_RATINGS = ("Strong Buy", "Buy")
SELL_RATINGS = ("Strong Sell", "Sell")

# The case library.
SHORT_HORIZON, LONG_HORIZON, HORIZON_TOLERANCE = 5, 20, 4
HOLD_RANGE = 0.01
OLDEST_PENDING_DAYS = 30
FEW_CASES = 3
BINS = ("vol_bin", "rsi_bin", "position_bin", "sector_bin", "score_bin")
BOUNDARY = (0.35, 0.45)


# --- certainty ---------------------------------------------------------------------------


def rule_factors(rules: DataFrame, inactive: str = "zero") -> DataFrame:
    """The inference rules as one row holding a map from rule id to factor.

    A rule that is switched off contributes nothing. With ``inactive="default"``
    it counts with its default factor, as if it were missing.
    """
    inference = rules.filter(F.col("category") == "inference")
    if inactive == "default":
        inference = inference.filter("is_active")
    factor = F.when(F.col("is_active"), F.col("certainty_factor")).otherwise(F.lit(0.0))
    pairs = F.collect_list(F.struct("rule_id", factor.alias("factor")))
    return inference.agg(F.map_from_entries(pairs).alias("factors"))


def with_certainty(df: DataFrame, rules: DataFrame, inactive: str = "zero") -> DataFrame:
    """Signed evidence of each vote and its combination, from the vote columns."""
    factors = rule_factors(rules, inactive).scalar()
    looked_up = df.withColumn("_factors", factors)
    evidence = {
        f"evidence_{rule.lower()}": F.col(vote).cast("double")
        * F.coalesce(F.try_element_at("_factors", F.lit(rule)), F.lit(default))
        for vote, (rule, default) in zip(VOTES, RULE_FACTORS.items())
    }
    combined = looked_up.withColumns(evidence).withColumn(
        "certainty", n.fold_certainty([F.col(e) for e in evidence])
    )
    certainty = F.col("certainty")
    magnitude = n.round_half_up(F.abs(certainty), 4)
    return combined.withColumns({
        **{f"cf_{rule.lower()}": n.round_half_up(F.col(f"evidence_{rule.lower()}"), 4)
           for rule in RULE_FACTORS},
        "combined_cf": n.round_half_up(certainty, 4),
        "cf_confidence": labels.confidence(certainty),
        "cf_buy_strength": F.when(certainty >= STRENGTH_LIMIT, magnitude).otherwise(F.lit(0.0)),
        "cf_sell_strength": F.when(certainty <= -STRENGTH_LIMIT, magnitude).otherwise(F.lit(0.0)),
    }).drop("_factors", "certainty", *evidence)


CERTAINTY_COLUMNS = ("combined_cf", "cf_confidence", "cf_buy_strength", "cf_sell_strength")


def cf_engine(ratings: DataFrame, rules: DataFrame, inactive: str = "zero") -> DataFrame:
    """One combined certainty factor per symbol and date."""
    votes = ratings.select("symbol", "date", *VOTES)
    return with_certainty(votes, rules, inactive).select(
        "symbol", "date", *[f"cf_{rule.lower()}" for rule in RULE_FACTORS], *CERTAINTY_COLUMNS
    )


# --- metarules ---------------------------------------------------------------------------


def streak_stage(over: Frame) -> dict[str, Column]:
    down = F.when(F.col("log_return") < DOWN_DAY, F.lit(1)).otherwise(F.lit(0))
    return {"down_days_3d": F.sum(down).over(over(DOWN_ROWS))}


def down_streak(volatility: DataFrame, **series: int | str) -> DataFrame:
    """Number of bars that lost more than 2% among the last three."""
    narrow = volatility.select("symbol", "date", "log_return", "annualized_vol")
    return with_series(narrow, [streak_stage], lookback=DOWN_ROWS - 1, **series)


def market_anomaly_rate(flags: DataFrame) -> DataFrame:
    """Share of the flagged instruments of a day that have a price outlier."""
    price_outlier = (F.col("anomaly_type") == "price_iqr") & F.col("is_anomaly")
    return flags.groupBy("date").agg(
        (F.count_if(price_outlier).cast("double") / F.count_distinct("symbol"))
        .alias("market_anomaly_rate")
    )


def with_metarules(df: DataFrame) -> DataFrame:
    """Metarule verdicts from the market rate, the down streak and the volatility."""
    c = F.col
    known = df.withColumns({
        "market_anomaly_rate": F.coalesce("market_anomaly_rate", F.lit(0.0)),
        "metarule_vol": F.coalesce("annualized_vol", F.lit(0.0)),
    })
    judged = known.withColumns({
        "m01_tighten_buy": c("market_anomaly_rate") > MARKET_ANOMALY_LIMIT,
        "m02_consecutive_down": c("down_days_3d") == DOWN_ROWS,
        "g03_extreme_volatility": c("metarule_vol") > VOLATILITY_LIMIT,
    })
    fired = F.concat(
        text.fragment(c("m01_tighten_buy"), "M01 "),
        text.fragment(c("m02_consecutive_down"), "M02 "),
        text.fragment(c("g03_extreme_volatility"), "G03"),
    )
    needed = F.when(c("m01_tighten_buy"), F.lit(SCORE_NEEDED_TIGHT)).otherwise(F.lit(SCORE_NEEDED))
    return judged.withColumns({
        "active_metarules": F.trim(fired), "required_score_for_buy": needed,
    })


def metarule_flags(flags: DataFrame, volatility: DataFrame, **series: int | str) -> DataFrame:
    rates = market_anomaly_rate(flags)
    joined = down_streak(volatility, **series).join(rates, "date", "left")
    return with_metarules(joined).select(
        "symbol", "date", "m01_tighten_buy", "m02_consecutive_down", "g03_extreme_volatility",
        "active_metarules", "required_score_for_buy",
        n.round_half_up(F.col("market_anomaly_rate"), 4).alias("market_anomaly_rate"),
        "down_days_3d", n.round_half_up(F.col("metarule_vol"), 4).alias("annualized_vol"),
    )


# --- signals -----------------------------------------------------------------------------


def signal_inputs(
    ratings: DataFrame,
    levels: DataFrame,
    volatility: DataFrame,
    anomalies: DataFrame,
    sectors: DataFrame,
    certainty: DataFrame,
    metarules: DataFrame,
) -> DataFrame:
    """Ratings enriched from the six other tables; ``anomalies`` is the pivoted form.

    All legs but the sector's share the key, so they reuse one partitioning.
    """
    per_day = [
        levels.select("symbol", "date", "high_52w", "low_52w", "pct_from_high", "pct_from_low",
                      "at_52w_high", "at_52w_low"),
        volatility.select("symbol", "date", "annualized_vol"),
        anomalies.select("symbol", "date", "has_price_anomaly", "has_volume_anomaly"),
        certainty.select("symbol", "date", *CERTAINTY_COLUMNS),
        metarules.select("symbol", "date", "m01_tighten_buy", "m02_consecutive_down",
                         "g03_extreme_volatility", "active_metarules", "required_score_for_buy"),
    ]
    joined = ratings.select(
        "symbol", "company_name", "sector", "market_cap_tier", "date", "close", "volume",
        "sma50", "sma200", "rsi14", "bb_lower", "bb_upper",
        "signal_score", "buy_signals", "sell_signals", "neutral_signals", "rating",
    )
    for table in per_day:
        joined = joined.join(table, ["symbol", "date"], "left")
    sector_days = sectors.select(
        "sector", "date", F.col("avg_daily_return").alias("sector_avg_return"),
        F.col("advance_ratio").alias("sector_advance_ratio"),
    )
    joined = joined.join(sector_days, ["sector", "date"], "left")
    return joined.fillna({
        "at_52w_high": False, "at_52w_low": False,
        "has_price_anomaly": False, "has_volume_anomaly": False,
        "combined_cf": 0.0, "cf_confidence": "LOW", "cf_buy_strength": 0.0,
        "cf_sell_strength": 0.0, "active_metarules": "", "required_score_for_buy": SCORE_NEEDED,
        "m01_tighten_buy": False, "m02_consecutive_down": False, "g03_extreme_volatility": False,
    })


def buy_gates() -> list[tuple[Column, Column]]:
    """What can stop a buy, in the order it is tested, with the text that says so."""
    c = F.col
    score = c("signal_score")
    advance = F.coalesce("sector_advance_ratio", F.lit(ADVANCE_LIMIT))
    return [
        (~c("rating").isin(*BUY_RATINGS),
         text.sentence("BUY not triggered: rating is '", c("rating"), "' (score=", score,
                       "/8, requires Buy or Strong Buy)")),
        (c("has_price_anomaly"),
         F.lit("BUY blocked by gate G01: price-IQR anomaly detected")),
        (advance < ADVANCE_LIMIT,
         text.sentence("BUY blocked by gate G02: sector advance ",
                       text.percent(c("sector_advance_ratio")), " < 50% threshold")),
        (score < c("required_score_for_buy"),
         text.sentence("BUY blocked by metarule M01: market-wide anomaly rate >30% requires score≥",
                       c("required_score_for_buy"), ", current score=", score)),
        (c("g03_extreme_volatility"),
         text.sentence("BUY blocked by gate G03: extreme volatility (",
                       text.percent(F.coalesce("annualized_vol", F.lit(0.0)), 1), " ann.)")),
        (c("m02_consecutive_down"),
         F.lit("BUY blocked by metarule M02: 3 consecutive down days (sustained selling pressure)")),
    ]


def sell_conditions() -> list[Column]:
    """What makes a sell, each on its own: the rating, or an outlier under a negative score."""
    c = F.col
    return [c("rating").isin(*SELL_RATINGS), c("has_price_anomaly") & (c("signal_score") < 0)]


def _surely(condition: Column) -> Column:
    """False where it is unknown whether the condition holds."""
    return F.coalesce(condition, F.lit(False))


def with_signal(inputs: DataFrame) -> DataFrame:
    """BUY when every gate is known to be open, else SELL, else HOLD; plus why it is no BUY.

    The signal and the reason against buying come from the same list, so they
    cannot disagree. A gate that cannot be judged stops a buy without a text of its own.
    """
    gates = buy_gates()
    open_ = reduce(Column.__and__, [_surely(~closed) for closed, _ in gates])
    sells = reduce(Column.__or__, [_surely(s) for s in sell_conditions()])
    reason = text.first_text(gates, F.lit("BUY not triggered"))
    return inputs.withColumns({
        "signal": F.when(open_, F.lit("BUY")).when(sells, F.lit("SELL")).otherwise(F.lit("HOLD")),
        "why_not_buy": F.when(~open_, reason),
        "confidence": labels.confidence(F.col("combined_cf")),
    })


def why_signal() -> Column:
    c = F.col
    rating, score = c("rating"), c("signal_score")
    certainty = text.fixed(c("combined_cf"), 2)
    advance = text.percent(F.coalesce("sector_advance_ratio", F.lit(0.0)))
    sell_rating = rating.isin(*SELL_RATINGS)
    bought = text.sentence("BUY: ", rating, " rating (CF=", certainty, ", score=+", score,
                           "/8) + no price anomaly + sector advance=", advance)
    sold = text.first_text([
        (sell_rating & c("has_price_anomaly"),
         text.sentence("SELL: ", rating, " rating (score=", score,
                       "/8) + price anomaly confirmed")),
        (sell_rating, text.sentence("SELL: ", rating, " rating (score=", score, "/8)")),
    ], text.sentence("SELL: price-IQR anomaly with negative signal score (", score, ")"))
    held = text.sentence("HOLD: ", rating, " rating (CF=", certainty, ", score=", score,
                         "/8) — insufficient conditions for BUY or SELL")
    return labels.by_value(c("signal"), {"BUY": bought, "SELL": sold}, held)


def why_not_sell() -> Column:
    """NULL for a SELL, else which half of the outlier condition is missing besides the rating."""
    c = F.col
    by_rating, _ = sell_conditions()
    missing = text.first_text([
        (~by_rating & ~c("has_price_anomaly"),
         text.sentence("SELL not triggered: rating is '", c("rating"), "' and no price anomaly")),
        (~by_rating & (c("signal_score") >= 0),
         text.sentence("SELL not triggered: price anomaly present but signal_score=",
                       c("signal_score"), " is non-negative (anomaly SELL requires score < 0)")),
    ], F.lit("SELL not triggered"))
    return F.when(c("signal") != "SELL", missing)


def reasoning_trace() -> Column:
    c = F.col
    direction = text.first_text([
        (c("combined_cf") >= STRENGTH_LIMIT, F.lit("BUY direction")),
        (c("combined_cf") <= -STRENGTH_LIMIT, F.lit("SELL direction")),
    ], F.lit("neutral"))
    passed = F.coalesce("sector_advance_ratio", F.lit(ADVANCE_LIMIT)) >= ADVANCE_LIMIT
    final = labels.by_value(c("signal"), {
        "BUY": text.sentence("BUY (", c("rating"), ")"),
        "SELL": text.sentence("SELL (", c("rating"), ")"),
    }, F.lit("HOLD"))
    return text.sentence(
        "1. CF engine: combined_cf=", text.fixed(c("combined_cf"), 2), " → ", direction, ". ",
        "2. Anomaly gate (G01): has_price_anomaly=", c("has_price_anomaly"), ". ",
        "3. Sector gate (G02): advance_ratio=",
        text.percent(F.coalesce("sector_advance_ratio", F.lit(0.0))),
        F.when(passed, F.lit(" [passed]")).otherwise(F.lit(" [BLOCKED]")), ". ",
        "4. Metarules: ",
        F.when(c("active_metarules") == "", F.lit("none")).otherwise(c("active_metarules")), ". ",
        "5. Final: ", final,
    )


def summary() -> Column:
    c = F.col
    volatility = F.coalesce("annualized_vol", F.lit(0.0))
    return F.concat(
        text.sentence("Rating: ", c("rating"), " (score=", c("signal_score"), "/8, buy=",
                      c("buy_signals"), ", sell=", c("sell_signals"), ")"),
        text.fragment(c("rsi14").isNotNull(), "; RSI(14)=", text.fixed(c("rsi14"), 1)),
        text.fragment(c("at_52w_high"), "; near 52W high (",
                      text.percent(F.abs("pct_from_high"), 1), " below)"),
        text.fragment(c("at_52w_low"), "; near 52W low (+",
                      text.percent(c("pct_from_low"), 1), " above)"),
        text.fragment(c("has_price_anomaly"), "; price anomaly"),
        text.fragment(c("has_volume_anomaly"), "; unusual volume"),
        text.fragment(volatility > HIGH_VOLATILITY_NOTE, "; high vol (",
                      text.percent(c("annualized_vol"), 1), " ann.)"),
        text.fragment(c("sector_advance_ratio").isNotNull(), "; sector advance=",
                      text.percent(c("sector_advance_ratio"))),
    )


SIGNAL_COLUMNS = (
    "symbol", "company_name", "sector", "market_cap_tier", "date", "close", "signal", "confidence",
    "explanation", "why_signal", "why_not_buy", "why_not_sell", "reasoning_trace",
    *CERTAINTY_COLUMNS, "active_metarules", "required_score_for_buy",
    "signal_score", "buy_signals", "sell_signals", "neutral_signals", "rating",
    "rsi14", "sma50", "sma200", "bb_lower", "bb_upper", "high_52w", "low_52w",
    "pct_from_high", "pct_from_low", "at_52w_high", "at_52w_low", "annualized_vol",
    "has_price_anomaly", "has_volume_anomaly", "sector_avg_return", "sector_advance_ratio",
)


def explain_signals(inputs: DataFrame) -> DataFrame:
    """Signal, confidence and the five explanation texts for complete inputs."""
    explained = with_signal(inputs).withColumns({
        "explanation": summary(),
        "why_signal": why_signal(),
        "why_not_sell": why_not_sell(),
        "reasoning_trace": reasoning_trace(),
    })
    # texts and gates use the full ratio, the column shows four digits
    return explained.withColumns(n.rounded(sector_advance_ratio=4)).select(*SIGNAL_COLUMNS)


def decision_signals(
    ratings: DataFrame,
    levels: DataFrame,
    volatility: DataFrame,
    flags: DataFrame,
    sectors: DataFrame,
    certainty: DataFrame,
    metarules: DataFrame,
) -> DataFrame:
    """Signals from the stored gold and decision tables."""
    anomalies = anomaly_pivot(flags)
    return explain_signals(
        signal_inputs(ratings, levels, volatility, anomalies, sectors, certainty, metarules)
    )


# --- case library ------------------------------------------------------------------------


def pending_signals(
    signals: DataFrame,
    outcomes: DataFrame,
    today: Column,
    *,
    youngest: int = SHORT_HORIZON,
    oldest: int | None = OLDEST_PENDING_DAYS,
) -> DataFrame:
    """Signals old enough to be judged whose outcome is not recorded yet, or not to the end.

    An outcome without a 20-day price is open until there is one, or the signal is
    older than ``oldest`` days. ``oldest=None`` looks at the whole history, as
    after a long break.
    """
    date = F.col("date")
    due = date <= F.date_sub(today, youngest)
    if oldest is not None:
        due = due & (date >= F.date_sub(today, oldest))
    recorded = outcomes.filter("close_20d IS NOT NULL").select("symbol", F.col("signal_date").cast("date").alias("date"))
    return signals.filter(due).select(
        "symbol", "date", "signal", "combined_cf", "signal_score", "sector",
        F.col("close").alias("close_at_signal"),
    ).join(recorded, ["symbol", "date"], "left_anti")


HORIZONS = {
    "close_5d": (SHORT_HORIZON, SHORT_HORIZON + HORIZON_TOLERANCE),
    "close_20d": (LONG_HORIZON, LONG_HORIZON + HORIZON_TOLERANCE),
}
LAST_DAY_AHEAD = LONG_HORIZON + HORIZON_TOLERANCE


def forward_close(signals: DataFrame, prices: DataFrame) -> DataFrame:
    """Adds the first close in days 5 to 9 and 20 to 24 after each row's date."""
    return with_forward_value(signals, prices, value="close", windows=HORIZONS)


def prices_in_play(pending: DataFrame, prices: DataFrame) -> DataFrame:
    """The prices that the outcomes of (stored) pending signals can depend on."""
    return in_play(pending, prices, LAST_DAY_AHEAD)


def case_outcomes(pending: DataFrame, prices: DataFrame) -> DataFrame:
    """Forward returns and WIN or LOSS; signals without a 5-day price are left out.

    A signal without a close starts from the price of its day. ``known_5d`` and
    ``known_20d`` are the days from which the two returns are known.
    """
    c = F.col
    found = with_forward_value(
        pending, prices, value="close", windows={"close_0d": (0, 0), **HORIZONS}, dates=True)
    begun = F.coalesce(F.when(c("close_at_signal") > 0, c("close_at_signal")), c("close_0d"))
    start = c("close_at_signal")
    priced = found.withColumn("close_at_signal", begun).filter(
        (start > 0) & c("close_5d").isNotNull()
    ).withColumns({
        "return_5d": n.pct_change(c("close_5d"), start),
        "return_20d": n.pct_change(c("close_20d"), start),
    }).withColumns(n.rounded(return_5d=6, return_20d=6))
    won = labels.by_value(c("signal"), {
        "BUY": c("return_5d") > 0, "SELL": c("return_5d") < 0,
    }, F.abs("return_5d") <= HOLD_RANGE)
    return priced.select(
        "symbol", c("date").alias("signal_date"), "signal",
        F.coalesce("combined_cf", F.lit(0.0)).alias("combined_cf"),
        F.coalesce("signal_score", F.lit(0)).alias("signal_score"),
        F.coalesce("sector", F.lit("")).alias("sector"),
        "close_at_signal", "close_5d", "close_20d", "return_5d", "return_20d",
        F.when(won, F.lit("WIN")).otherwise(F.lit("LOSS")).alias("outcome"),
        c("close_5d_date").alias("known_5d"), c("close_20d_date").alias("known_20d"),
    )


def with_bins(df: DataFrame) -> DataFrame:
    """The five feature bins cases are compared by."""
    c = F.col
    return df.withColumns({
        "vol_bin": labels.volatility_bin(c("annualized_vol")),
        "rsi_bin": labels.rsi_bin(c("rsi14")),
        "position_bin": labels.position_bin(c("pct_from_high")),
        "sector_bin": labels.sector_bin(c("sector_advance_ratio")),
        "score_bin": labels.score_bin(c("signal_score")),
    })


def feature_bins(signals: DataFrame) -> DataFrame:
    return with_bins(signals).select("symbol", "date", "signal", *BINS)


def judged_cases(signals: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Recorded outcomes with the features their signal had."""
    recorded = outcomes.filter(F.col("outcome").isNotNull()).select(
        "symbol", F.col("signal_date").cast("date").alias("date"),
        F.col("signal").alias("case_signal"), F.col("signal_score"),
        "outcome", "return_5d", "return_20d", "known_5d", "known_20d",
    )
    features = signals.select(
        "symbol", "date", "annualized_vol", "rsi14", "pct_from_high", "sector_advance_ratio"
    )
    return with_bins(recorded.join(features, ["symbol", "date"])).select(
        "symbol", "date", "case_signal", "outcome", "return_5d", "return_20d", "known_5d",
        "known_20d", *BINS
    )


def _measures() -> dict[str, dict[str, Column]]:
    """Case totals by the day they are known from.

    They are whole numbers; returns carry six decimals, so millionths are exact.
    """
    c = F.col

    def flag(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    def millionths(value: Column) -> Column:
        return F.coalesce(F.round(value * 1e6).cast("bigint"), F.lit(0).cast("bigint"))

    judged = {
        "cases": F.lit(1).cast("bigint"),
        "wins": flag(c("outcome") == "WIN"),
        "buys": flag(c("case_signal") == "BUY"),
        "sells": flag(c("case_signal") == "SELL"),
        "holds": flag(c("case_signal") == "HOLD"),
        "with_5d": flag(c("return_5d").isNotNull()),
        "sum_5d": millionths(c("return_5d")),
    }
    later = {
        "with_20d": flag(c("return_20d").isNotNull()),
        "sum_20d": millionths(c("return_20d")),
    }
    return {"known_5d": judged, "known_20d": later}


def case_totals(signals: DataFrame, outcomes: DataFrame) -> DataFrame:
    """What has become known about the cases, by symbol, bins and ``known_month``; ``known_on`` is that month's first."""
    daily = daily_totals(judged_cases(signals, outcomes), group=["symbol"], labels=BINS, measures=_measures())
    names = [n for some in _measures().values() for n in some]
    months = monthly_totals(daily, group=["symbol"], labels=BINS, names=names)
    first = F.make_date(F.floor(F.col("known_month") / 100).cast("int"), F.col("known_month") % 100, F.lit(1))
    return months.withColumn("known_on", first)


def cbr_lookup(
    signals: DataFrame, outcomes: DataFrame, known_only: bool = True, features: DataFrame | None = None,
    before: DataFrame | None = None, since: Column | None = None,
) -> DataFrame:
    """For each signal what happened after similar ones of the same symbol.

    Similar means at least three of the five bins agree. By default a case counts
    from the day of its 5-day price on, and its 20-day return from the day of that
    price, so nothing is taken from the future; ``known_only=False`` compares with
    the whole library. ``features`` are the signals that the cases were, by default
    ``signals``. With the stored ``before`` (:func:`case_totals` of the months before that of ``since``), ``outcomes``
    and ``features`` need to hold only the cases of which something becomes known from ``since`` on.
    """
    c = F.col
    current = feature_bins(signals)
    cases = judged_cases(signals if features is None else features, outcomes)
    if known_only:
        totals = similar_totals_known(
            current, cases, group=["symbol"], labels=BINS, measures=_measures(), at="date", before=before, since=since,
        )
        found = current.join(totals, ["symbol", *BINS, "date"], "left")
    else:
        totals = similar_totals(
            current, cases, group=["symbol"], labels=BINS,
            measures={n: m for some in _measures().values() for n, m in some.items()},
        )
        found = current.join(totals, ["symbol", *BINS], "left")

    def share(part: Column) -> Column:
        return n.round_half_up(n.ratio(part.cast("double"), c("cases").cast("double")), 3)

    def mean(sum_: str, count: str) -> Column:
        return n.round_half_up(n.ratio(c(sum_) / 1e6, c(count).cast("double")), 4)

    agreeing = labels.by_value(c("signal"), {"BUY": c("buys"), "SELL": c("sells")}, c("holds"))
    nothing = F.lit(0.0)
    figures = found.withColumns({
        "similar_cases_count": F.coalesce("cases", F.lit(0).cast("bigint")),
        "cbr_avg_return_5d": F.coalesce(mean("sum_5d", "with_5d"), nothing),
        "cbr_avg_return_20d": F.coalesce(mean("sum_20d", "with_20d"), nothing),
        "cbr_win_rate": F.coalesce(share(c("wins")), nothing),
        "cbr_signal_agreement": F.coalesce(share(agreeing), nothing),
    })
    note = text.first_text([
        (c("similar_cases_count") < FEW_CASES,
         F.lit("Insufficient history (< 3 similar cases found)")),
    ], text.sentence(
        "Based on ", c("similar_cases_count"), " similar past cases: ",
        text.percent(c("cbr_win_rate")), " win rate, avg 5d return=",
        text.percent(c("cbr_avg_return_5d"), 1),
    ))
    return figures.withColumn("cbr_note", note).select(
        "symbol", "date", "similar_cases_count", "cbr_avg_return_5d", "cbr_avg_return_20d",
        "cbr_win_rate", "cbr_signal_agreement", "cbr_note",
    )


def validation(outcomes: DataFrame, signals: DataFrame) -> DataFrame:
    """Accuracy per month, signal and sector."""
    c = F.col
    recorded = outcomes.filter(c("outcome").isNotNull()).select(
        "symbol", c("signal_date").cast("date").alias("date"), "signal",
        "return_5d", "return_20d", "outcome",
    )
    judged = recorded.join(
        signals.select("symbol", "date", "combined_cf", "sector"), ["symbol", "date"]
    )
    won = F.count_if(c("outcome") == "WIN")
    accuracy = n.round_half_up(won.cast("double") / F.count(F.lit(1)), 3)
    near = F.abs("combined_cf").between(*BOUNDARY)
    grouped = judged.groupBy(dates.month_of(c("date")).alias("month"), "signal", "sector").agg(
        F.count(F.lit(1)).alias("total_signals"),
        won.alias("wins"),
        F.count_if(c("outcome") == "LOSS").alias("losses"),
        accuracy.alias("accuracy"),
        accuracy.alias("reliability"),
        n.round_half_up(F.avg("return_5d"), 4).alias("avg_return_5d"),
        n.round_half_up(F.avg("return_20d"), 4).alias("avg_return_20d"),
        n.round_half_up(F.stddev_samp("return_5d"), 4).alias("stddev_return_5d"),
        F.count_if(near).alias("threshold_sensitive_count"),
        accuracy.alias("sector_accuracy"),
    )
    return grouped.orderBy(F.col("month").desc(), "signal", "sector")


# --- conformance -------------------------------------------------------------------------

STATE_COLUMNS = (
    "rating_category", "has_price_anomaly", "sector_advance_gte_50pct", "signal_score_negative",
    "any_metarule_blocks_buy",
)


def decision_states(inputs: DataFrame) -> DataFrame:
    """Signals with the conditions of the decision table as text, from ``signal_inputs`` columns.

    ``sector_advance_ratio`` must be the full ratio.
    """
    c = F.col
    blocks = (
        c("m02_consecutive_down") | c("g03_extreme_volatility")
        | (c("m01_tighten_buy") & (c("signal_score") < c("required_score_for_buy")))
    )
    advance = F.coalesce("sector_advance_ratio", F.lit(ADVANCE_LIMIT))
    return with_signal(inputs).select(
        F.lower(F.translate("rating", " ", "_")).alias("rating_category"),
        c("has_price_anomaly").cast("string").alias("has_price_anomaly"),
        (advance >= ADVANCE_LIMIT).cast("string").alias("sector_advance_gte_50pct"),
        (c("signal_score") < 0).cast("string").alias("signal_score_negative"),
        blocks.cast("string").alias("any_metarule_blocks_buy"),
        "signal",
    )


def decision_table_report(
    inputs: DataFrame, table: DataFrame, conditions: Sequence[str] = STATE_COLUMNS
) -> DataFrame:
    return against_decision_table(
        decision_states(inputs), table, conditions=conditions, given="signal",
        expected="expected_signal", row_id="state_id",
    )
