"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """The row with the greatest ``by`` of each key; equal ones are told apart by their content.

    Spark limits each map task to one row per key before the shuffle
    (``WindowGroupLimit``), so a key that holds much of the data stays cheap.
    """
    rest = [F.col(c).desc() for c in df.columns if c not in {*keys, by}]
    order = Window.partitionBy(*keys).orderBy(F.col(by).desc(), *rest)
    return df.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")
