"""Batch outlier detectors over half-yearly runs.

A run scores six months and learns from them and the twelve before. All runs of
a history are computed in one job: a row is copied to the run that scores it
and to the two that look back at it. A group is then one symbol in one run, at
most 18 months of daily bars, however long the history and however large a
symbol's share of it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions import dates, numeric as n
from tickloom.operators.forest import Draws, HalvingDraws, RandomDraws, forest_nodes, grown_forests, with_isolation_score
from tickloom.operators.series import Frame, rolling_mean, rolling_std, with_series

# The runs and the detectors' settings.
RUN_MONTHS, LOOKBACK_MONTHS = 6, 12
CONTAMINATION = 0.05
MIN_ROWS = 60
TREES, TREE_SAMPLE, SEED = 100, 256, 42
Z_ROWS, Z_MIN_ROWS, Z_LIMIT = 30, 5, 2.5
FENCE_WIDTH, FENCE_MIN_ROWS, SMALLEST_SPREAD = 1.5, 4, 1e-9
FOREST_FEATURES = ("log_return", "vol_20d", "volume")
FEATURE_COLUMNS = (
    "symbol", "date", "log_return", "vol_5d", "vol_10d", "vol_20d", "annualized_vol", "volume",
    "close",
)
GROUP = ["window_start", "symbol"]


def run_features(volatility: DataFrame, start: str) -> DataFrame:
    """Input of the single run that scores the six months from ``start``."""
    first = F.lit(start).cast("date")
    date = F.col("date")
    return volatility.filter(
        F.col("log_return").isNotNull()
        & (date >= F.add_months(first, -LOOKBACK_MONTHS)) & (date < F.add_months(first, RUN_MONTHS))
    ).select(first.alias("window_start"), *FEATURE_COLUMNS, (date >= first).alias("is_scored"))


def ml_features(volatility: DataFrame) -> DataFrame:
    """Input of all half-yearly runs."""
    own = dates.half_year_of(F.col("date"))
    runs = F.array(*[F.add_months(own, m) for m in range(0, LOOKBACK_MONTHS + 1, RUN_MONTHS)])
    return (
        volatility.filter(F.col("log_return").isNotNull())
        .select(F.explode(runs).alias("window_start"), *FEATURE_COLUMNS)
        .withColumn("is_scored", F.col("window_start") == dates.half_year_of(F.col("date")))
    )


def _verdicts(scored: DataFrame, kind: str, score: Column, threshold: float, outlier: Column) -> DataFrame:
    return scored.filter("is_scored").select(
        "symbol", "date", F.lit(kind).alias("anomaly_type"),
        n.round_half_up(score, 4).alias("score"),
        F.lit(float(threshold)).alias("threshold"), outlier.alias("is_anomaly"),
    )


def zscore_scale(features: DataFrame) -> DataFrame:
    """The forest's features standardised within each group, and volume scaled to [0, 1]."""
    whole = Window.partitionBy(*GROUP)
    complete = features.dropna(subset=list(FOREST_FEATURES))
    moments = {f"{f}_mean": F.avg(f).over(whole) for f in FOREST_FEATURES}
    spreads = {f"{f}_std": F.stddev_pop(f).over(whole) for f in FOREST_FEATURES}
    extremes = {"low": F.min("volume").over(whole), "high": F.max("volume").over(whole)}
    measured = complete.withColumns({**moments, **spreads, **extremes})

    def scaled(f: str) -> Column:
        spread = F.col(f"{f}_std")
        z = F.when(spread > n.MARGIN, (F.col(f) - F.col(f"{f}_mean")) / spread).otherwise(F.lit(0.0))
        return n.round_half_up(z, 6).alias(f"{f}_scaled")

    width = (F.col("high") - F.col("low")).cast("double")
    relative = F.when(width > 0, (F.col("volume") - F.col("low")) / width).otherwise(F.lit(0.0))
    return measured.select(
        *GROUP, "date", *[scaled(f) for f in FOREST_FEATURES],
        n.round_half_up(relative, 6).alias("volume_minmax"),
    )


def _to_judge(features: DataFrame) -> DataFrame:
    """The forest's input: the rows of all groups in which there is a row to judge."""
    # marked in the partitioning that growing needs as well, so the input is read once
    judged = F.bool_or("is_scored").over(Window.partitionBy(*GROUP))
    narrow = features.select(*GROUP, "date", "is_scored", *FOREST_FEATURES)
    return narrow.withColumn("is_judged", judged).filter("is_judged").drop("is_judged")


def forest_scores(
    features: DataFrame, trees: int = TREES, draws: Callable[[Sequence[int]], Draws] = RandomDraws
) -> DataFrame:
    """Isolation scores of all rows of the groups with a row to judge.

    The forest compares each feature only with cuts drawn between its own
    extremes, so scaling the features first would not change the outcome.
    """
    return with_isolation_score(
        _to_judge(features), group=GROUP, order="date", features=FOREST_FEATURES, min_rows=MIN_ROWS,
        trees=trees, sample=TREE_SAMPLE, seed=SEED, draws=draws,
    )


def halving_nodes(features: DataFrame) -> DataFrame:
    """The nodes of a forest without chance, a tree beginning with each feature."""
    forests = grown_forests(
        _to_judge(features), group=GROUP, order="date", features=FOREST_FEATURES, min_rows=MIN_ROWS,
        trees=len(FOREST_FEATURES), sample=TREE_SAMPLE, seed=SEED, draws=HalvingDraws,
    )
    return forest_nodes(forests, GROUP)


def isolation_forest(features: DataFrame) -> DataFrame:
    """Isolation scores, scaled to [0, 1] per group, flagged above the group's 95th percentile."""
    return forest_verdicts(forest_scores(features))


def halving_forest(features: DataFrame) -> DataFrame:
    """The verdicts of the forest without chance; its scores are rounded, as they tie where paths agree."""
    scored = forest_scores(features, len(FOREST_FEATURES), HalvingDraws)
    return forest_verdicts(scored.withColumn("isolation", n.round_half_up(F.col("isolation"), 9)))


def forest_verdicts(isolated: DataFrame) -> DataFrame:
    """Verdicts from the column ``isolation``: scaled to [0, 1], flagged above the cut of each group."""
    whole = Window.partitionBy(*GROUP)
    scored = isolated.withColumns({
        "low": F.min("isolation").over(whole),
        "high": F.max("isolation").over(whole),
        "cut": F.percentile("isolation", F.lit(1.0 - CONTAMINATION)).over(whole),
    })
    width = F.col("high") - F.col("low")
    relative = F.when(width > 0, (F.col("isolation") - F.col("low")) / width).otherwise(F.lit(0.0))
    return _verdicts(
        scored, "isolation_forest", relative, CONTAMINATION, F.col("isolation") > F.col("cut")
    )


def batch_volume_zscore(features: DataFrame) -> DataFrame:
    """Volume z-score of each scored day; days without enough history score 0."""

    def stage(over: Frame) -> dict[str, Column]:
        return {
            "mean": rolling_mean("volume", over, Z_ROWS, Z_MIN_ROWS),
            "std": rolling_std("volume", over, Z_ROWS, Z_MIN_ROWS),
        }

    rolled = with_series(
        features.select(*GROUP, "date", "is_scored", "volume"), [stage], keys=GROUP
    )
    z = F.when(F.col("std") > 0, (F.col("volume") - F.col("mean")) / F.col("std"))
    scored = rolled.withColumn("z", F.coalesce(z, F.lit(0.0)))
    return _verdicts(scored, "volume_zscore", F.col("z"), Z_LIMIT, F.abs("z") > Z_LIMIT)


def batch_price_iqr(features: DataFrame) -> DataFrame:
    """Simple return against the Tukey fences of the group's whole history."""
    c = F.col
    ordered = Window.partitionBy(*GROUP).orderBy("date")
    whole = Window.partitionBy(*GROUP)
    returns = features.select(*GROUP, "date", "is_scored", "close").withColumn(
        "change", n.pct_change(c("close"), F.lag("close").over(ordered))
    )
    measured = returns.withColumns({
        "quartiles": F.percentile("change", F.array(F.lit(0.25), F.lit(0.75))).over(whole),
        "known": F.count("change").over(whole),
    }).filter(c("known") >= FENCE_MIN_ROWS)
    fenced = measured.withColumns({
        "q1": F.get("quartiles", F.lit(0)), "q3": F.get("quartiles", F.lit(1)),
        "change": F.coalesce("change", F.lit(0.0)),
    }).withColumn("spread", c("q3") - c("q1")).withColumns({
        "low_fence": c("q1") - FENCE_WIDTH * c("spread"),
        "high_fence": c("q3") + FENCE_WIDTH * c("spread"),
    })
    overshoot = F.greatest(
        c("low_fence") - c("change"), c("change") - c("high_fence"), F.lit(0.0)
    )
    outside = n.below(c("change"), c("low_fence")) | n.above(c("change"), c("high_fence"))
    # what lies within noise of a fence is on it
    score = F.when(outside, overshoot / F.greatest(c("spread"), F.lit(SMALLEST_SPREAD))).otherwise(
        F.lit(0.0)
    )
    return _verdicts(fenced, "price_iqr", score, FENCE_WIDTH, outside)


def detect_all(
    features: DataFrame, forest: Callable[[DataFrame], DataFrame] = isolation_forest
) -> DataFrame:
    """The verdicts of the three detectors as one long table."""
    return (
        forest(features)
        .unionByName(batch_volume_zscore(features))
        .unionByName(batch_price_iqr(features))
    )


def triple_agreement(verdicts: DataFrame) -> DataFrame:
    """One row per symbol and date with each detector's verdict and whether all agree."""

    def fired(kind: str) -> Column:
        this = (F.col("anomaly_type") == kind) & F.col("is_anomaly")
        return F.coalesce(F.bool_or(this), F.lit(False))

    wide = verdicts.groupBy("symbol", "date").agg(
        fired("isolation_forest").alias("by_forest"),
        fired("volume_zscore").alias("by_volume"),
        fired("price_iqr").alias("by_price"),
    )
    return wide.withColumn("all_agree", F.expr("by_forest AND by_volume AND by_price"))
