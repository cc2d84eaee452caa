"""The analyst's questions to the finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.numeric import round_half_up

WELL_BACKED = 0.65


def on_latest_date(df: DataFrame) -> DataFrame:
    return df.filter(F.col("date") == df.agg(F.max("date")).scalar())


def latest_buys(signals: DataFrame) -> DataFrame:
    """Confident buys of the latest day, the most certain first."""
    return (
        on_latest_date(signals)
        .filter((F.col("signal") == "BUY") & (F.col("confidence") == "HIGH"))
        .select("symbol", "company_name", "sector", "close", "combined_cf", "why_signal")
        .orderBy(F.col("combined_cf").desc(), "symbol")
    )


def blocked_buys(signals: DataFrame) -> DataFrame:
    """Buy ratings that ended as HOLD, with the gate that stopped them."""
    return (
        on_latest_date(signals)
        .filter((F.col("signal") == "HOLD") & F.col("rating").isin("Buy", "Strong Buy"))
        .select("symbol", "signal_score", "combined_cf", "why_not_buy", "active_metarules")
        .orderBy(F.col("combined_cf").desc(), "symbol")
    )


def symbol_trace(signals: DataFrame, symbol: str, newest: int = 10) -> DataFrame:
    """One symbol's reasoning, newest first."""
    return (
        signals.filter(F.col("symbol") == symbol)
        .select("date", "signal", "reasoning_trace", "why_signal", "why_not_buy")
        .orderBy(F.col("date").desc()).limit(newest)
    )


def sells_near_high(signals: DataFrame) -> DataFrame:
    return (
        on_latest_date(signals)
        .filter((F.col("signal") == "SELL") & F.col("at_52w_high"))
        .select("symbol", "close", "high_52w", "pct_from_high", "why_signal", "reasoning_trace")
    )


def metarules_on_latest_date(metarules: DataFrame) -> DataFrame:
    """How many symbols each combination of fired metarules affects."""
    return (
        on_latest_date(metarules).filter(F.col("active_metarules") != "")
        .groupBy("date", "active_metarules").agg(F.count(F.lit(1)).alias("symbols_affected"))
        .orderBy(F.col("symbols_affected").desc(), "active_metarules")
    )


def backed_buys(signals: DataFrame, lookup: DataFrame) -> DataFrame:
    """Buys of the latest day whose similar past cases mostly won."""
    buys = on_latest_date(signals).filter(F.col("signal") == "BUY")
    backed = lookup.filter(F.col("cbr_win_rate") >= WELL_BACKED)
    return (
        buys.join(backed, ["symbol", "date"])
        .select("symbol", "close", "why_signal", "cbr_win_rate", "cbr_avg_return_5d", "cbr_note")
        .orderBy(F.col("cbr_win_rate").desc(), "symbol")
    )


def accuracy_by_month(validation: DataFrame) -> DataFrame:
    return validation.select(
        "month", "signal", "sector", "total_signals", "accuracy", "reliability", "avg_return_5d",
        "threshold_sensitive_count",
    ).orderBy(F.col("month").desc(), "signal", "sector")


def active_rules(rules: DataFrame) -> DataFrame:
    return rules.filter("is_active").select(
        "rule_id", "rule_name", "category", "certainty_factor", "condition_description"
    ).orderBy("category", "rule_id")


def rows_per_symbol(**tables: DataFrame) -> DataFrame:
    """Row counts per symbol and table, as long rows."""
    counted = None
    for name, table in tables.items():
        one = table.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), "symbol", "n"
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted


def newest_volatility(volatility: DataFrame, rows: int = 10) -> DataFrame:
    """The newest known volatilities in percent."""
    return (
        volatility.select(
            "symbol", "date", round_half_up(F.col("annualized_vol") * 100, 1).alias("vol_pct")
        )
        .orderBy(F.col("date").desc(), "symbol").limit(rows)
    )


def newest_anomalies(flags: DataFrame, rows: int = 10) -> DataFrame:
    return (
        flags.filter("is_anomaly").select("symbol", "date", "anomaly_type", "score", "is_anomaly")
        .orderBy(F.col("date").desc(), "symbol", "anomaly_type").limit(rows)
    )
