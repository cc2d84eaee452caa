"""Table checks that return a report and never fail the run by themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column in one pass: ``column_name, rows, failures``."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return counts.unpivot("rows", list(columns), "column_name", "failures").select(
        "column_name", "rows", "failures"
    )


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the rows they hold."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeated.agg(
        F.count(F.lit(1)).alias("repeated_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_involved"),
    ).select(F.lit(",".join(keys)).alias("key"), "repeated_keys", "rows_involved")


def accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the list with their counts; NULL is not a value and passes."""
    value = F.col(column)
    return (
        df.filter(value.isNotNull() & ~value.isin(list(accepted)))
        .groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit(column).alias("column_name"), "value", "failures")
    )


def age_hours(newest: Column, now: str) -> Column:
    return (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(newest.cast("timestamp"))) / 3.6e9


def age_status(newest: Column, now: str, warn_hours: float, error_hours: float | None = None) -> Column:
    """``pass``, ``warn`` or ``error`` by the age of the newest row; no row is an error."""
    age = age_hours(newest, now)
    limit = F.lit(None).cast("double") if error_hours is None else F.lit(float(error_hours))
    return (
        F.when(age.isNull(), F.lit("error"))
        .when(age > limit, F.lit("error"))
        .when(age > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )


def freshness(
    df: DataFrame, stamp: str, now: str, warn_hours: float, error_hours: float | None = None
) -> DataFrame:
    """Age of the newest row against the two limits; an empty table is an error."""
    newest = F.col("newest")
    return df.agg(F.max(stamp).alias("newest")).select(
        age_hours(newest, now).alias("age_hours"),
        age_status(newest, now, warn_hours, error_hours).alias("status"),
    )


def against_decision_table(
    cases: DataFrame,
    table: DataFrame,
    *,
    conditions: Sequence[str],
    given: str,
    expected: str,
    row_id: str,
    wildcard: str = "any",
    domain: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """How the cases spread over the rows of a decision table.

    One row per table row (``row_id``) and given outcome, with the number of
    cases; ``row_id`` NULL collects cases no table row describes. Cases are
    counted per distinct condition tuple first, and a wildcard is written out
    over its domain, so the lookup is an equi-join of two small tables.
    """
    grouped = cases.groupBy(*conditions, given).agg(F.count(F.lit(1)).alias("cases"))
    spelled = table.select(row_id, *conditions, expected)
    for column in conditions:
        values = (domain or {}).get(column, ("true", "false"))
        options = F.when(
            F.col(column) == wildcard, F.array(*[F.lit(v) for v in values])
        ).otherwise(F.array(F.col(column)))
        spelled = spelled.withColumn(column, F.explode(options))
    matched = grouped.join(spelled, list(conditions), "left")
    return (
        matched.groupBy(row_id, F.col(given).alias("given"), F.col(expected).alias("expected"))
        .agg(F.sum("cases").alias("cases"))
        .withColumn("conforms", F.col("given") == F.col("expected"))
    )
