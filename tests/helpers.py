"""Small inputs for the model tests."""

from __future__ import annotations

import datetime as dt

DAY = dt.date(2024, 1, 1)


def bars(spark, closes, symbol="A", start=DAY, volumes=None, skip=()):
    """One bar per close on consecutive days; positions in ``skip`` have no bar."""
    rows = []
    for k, close in enumerate(closes):
        if k in skip:
            continue
        volume = volumes[k] if volumes else 100
        rows.append((symbol, start + dt.timedelta(days=k), float(close), float(close), float(close),
                     float(close), volume))
    return spark.createDataFrame(
        rows, "symbol string, date date, open double, high double, low double, close double, "
              "volume bigint"
    )


def symbols(spark, *names, sector="Energy"):
    return spark.createDataFrame(
        [(n, f"{n} Co", sector, "Large") for n in names],
        "symbol string, company_name string, sector string, market_cap_tier string",
    )


def same_rows(left, right):
    """Both frames hold the same rows, duplicates included."""
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
