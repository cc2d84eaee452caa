"""What the stored tables must hold: required columns, accepted values, keys, age."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators import quality

# The labels of the models.
SIGNALS = ("BUY", "SELL", "HOLD")
STRENGTHS = ("HIGH", "MEDIUM", "LOW")
RATINGS = ("Strong Buy", "Buy", "Neutral", "Sell", "Strong Sell")
STATUSES = ("live", "simulated", "pre-market", "post-market")


@dataclass(frozen=True)
class Contract:
    """The columns that are never NULL (those of the key included), the labels of others, the newest row's age."""

    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    accepted: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    date: str = "date"
    stamp: str | None = None
    warn_hours: float = 24
    error_hours: float | None = None


_DAY = ("symbol", "date")
CONTRACTS = {
    "silver_ohlcv": Contract(
        _DAY, ("open", "high", "low", "close", "volume"), stamp="ingestion_time", warn_hours=25),
    "silver_ticks": Contract(
        ("symbol", "event_time"), ("price", "volume"), {"session_status": STATUSES}, "event_date",
        stamp="ingestion_time", error_hours=48),
    "gold_intraday_vwap": Contract(("symbol", "session_date"), ("vwap", "sector"), date="session_date"),
    "gold_sector_performance": Contract(("sector", "date"), ("symbol_count",)),
    "gold_volatility_index": Contract(_DAY, ("volume",)),
    "gold_anomaly_flags": Contract(
        (*_DAY, "anomaly_type"), ("is_anomaly",), {"anomaly_type": ("volume_zscore", "price_iqr")}),
    "gold_technical_rating": Contract(_DAY, ("rating",), {"rating": RATINGS}),
    "gold_52w_levels": Contract(_DAY, ("high_52w", "low_52w")),
    "decision_cf_engine": Contract(_DAY, ("combined_cf", "cf_confidence"), {"cf_confidence": STRENGTHS}),
    "decision_metarule_flags": Contract(_DAY, ("required_score_for_buy",)),
    "decision_signals": Contract(
        _DAY, ("close", "signal", "confidence", "explanation", "why_signal", "reasoning_trace"),
        {"signal": SIGNALS, "confidence": STRENGTHS, "cf_confidence": STRENGTHS}),
    "decision_case_outcomes": Contract(
        ("symbol", "signal_date"), (), {"signal": SIGNALS, "outcome": ("WIN", "LOSS")}, "signal_date"),
    "decision_cbr_lookup": Contract(_DAY),
}


def table_report(name: str, df: DataFrame, contract: Contract, now: str | None = None) -> DataFrame:
    """One row per test of a table: ``table_name, test, subject, failures, status``.

    ``failures`` counts rows, for the key those that share theirs. The age is only tested where a ``now`` is given,
    and fails once. An empty table passes all but that.

    The table is read once: everything is counted per key, which uniqueness needs anyway, and added up.
    """
    required = (*contract.key, *contract.required)
    stamp = contract.stamp if now is not None else None
    failing = {
        **{("not_null", c): F.col(c).isNull() for c in required},
        **{("accepted_values", c): ~F.col(c).isin(list(values)) for c, values in contract.accepted.items()},
    }
    counted = {f"_{k}": F.count_if(failure) for k, failure in enumerate(failing.values())}
    newest = [F.max(stamp).alias("_newest")] if stamp else []
    of_keys = [F.col(c).alias(f"_key_{k}") for k, c in enumerate(contract.key)]
    by_key = df.groupBy(*of_keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[c.alias(k) for k, c in counted.items()], *newest)
    totals = by_key.agg(
        F.sum(F.when(F.col("_rows") > 1, F.col("_rows"))).alias("_shared"),
        *[F.sum(k).alias(k) for k in counted], *[F.max("_newest").alias("_newest") for _ in newest])

    def told(test: str, subject: str, failures: Column, status: Column | None = None) -> Column:
        failures = F.coalesce(failures, F.lit(0)).cast("long")
        status = F.when(failures > 0, "error").otherwise("pass") if status is None else status
        return F.struct(
            F.lit(name).alias("table_name"), F.lit(test).alias("test"), F.lit(subject).alias("subject"),
            failures.alias("failures"), status.alias("status"))

    tests = [told(test, subject, F.col(k)) for (test, subject), k in zip(failing, counted)]
    tests.insert(len(required), told("unique", ",".join(contract.key), F.col("_shared")))
    if stamp:
        age = quality.age_status(F.col("_newest"), now, contract.warn_hours, contract.error_hours)
        tests.append(told("freshness", stamp, F.when(age == "pass", 0).otherwise(1), age))
    return totals.select(F.inline(F.array(*tests)))
