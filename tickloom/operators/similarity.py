"""Counting similar past cases without pairing them up.

Two cases are similar when at least three of their five labels agree. How many
cases agree with a given one on a fixed subset of labels is a plain grouped
count, and those counts add up to the number of similar cases: with weight +1
for each subset of three, -3 for each of four and +6 for all five, a case that
agrees on exactly 3, 4 or 5 labels is counted 1, 4 - 3 and 10 - 15 + 6 times,
which is once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

SUBSET_WEIGHTS = {3: 1, 4: -3, 5: 6}


def _subsets(labels: Sequence[str]) -> Column:
    """One struct per label subset: its number, weight, and the labels it keeps as text."""
    subsets = [s for size in SUBSET_WEIGHTS for s in combinations(labels, size)]
    return F.array(*[
        F.struct(
            F.lit(number).alias("subset"),
            F.lit(SUBSET_WEIGHTS[len(kept)]).alias("weight"),
            F.concat_ws("|", *[F.col(c) for c in kept]).alias("kept"),
        )
        for number, kept in enumerate(subsets)
    ])


def similar_totals(
    probes: DataFrame,
    cases: DataFrame,
    *,
    group: Sequence[str],
    labels: Sequence[str],
    measures: Mapping[str, Column],
) -> DataFrame:
    """For each distinct probe the sum of ``measures`` over the similar cases of its group.

    ``measures`` are whole numbers, so that the weighted sums are exact. Probes
    without a similar case are left out.
    """
    spread = [*group, "subset", "kept"]
    sums = (
        cases.select(*group, F.inline(_subsets(labels)), *[m.alias(n) for n, m in measures.items()])
        .groupBy(*spread).agg(*[F.sum(n).alias(n) for n in measures])
    )
    keys = [*group, *labels]
    wanted = probes.select(*keys).distinct().select("*", F.inline(_subsets(labels)))
    weighted = [F.sum(F.col("weight") * F.col(n)).alias(n) for n in measures]
    return wanted.join(sums, spread).groupBy(*keys).agg(*weighted)


def month_of(day: Column) -> Column:
    """The month of a day as a whole number, 199903."""
    return F.year(day) * 100 + F.month(day)


def daily_totals(
    cases: DataFrame, *, group: Sequence[str], labels: Sequence[str], measures: Mapping[str, Mapping[str, Column]],
) -> DataFrame:
    """The sums of ``measures`` by group, labels and the day ``_day`` from which they are known.

    ``measures`` are grouped by the column that holds that day; where it is NULL they never are known.
    """
    names, none = [n for some in measures.values() for n in some], F.lit(0).cast("long")
    # a row for each day on which something about the case becomes known
    news = F.array(*[
        F.struct(F.col(known).alias("_day"), *[
            (some[n].cast("long") if n in some else none).alias(n) for n in names
        ]) for known, some in measures.items()
    ])
    told = cases.select(*group, *labels, F.inline(news)).filter(F.col("_day").isNotNull())
    return told.groupBy(*group, *labels, "_day").agg(*[F.sum(n).alias(n) for n in names])


def monthly_totals(daily: DataFrame, *, group: Sequence[str], labels: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Daily totals added up by the month in which they become known: what is stored of the past."""
    return daily.groupBy(*group, *labels, month_of(F.col("_day")).alias("known_month")).agg(*[F.sum(n).alias(n) for n in names])


def similar_totals_known(
    probes: DataFrame,
    cases: DataFrame,
    *,
    group: Sequence[str],
    labels: Sequence[str],
    measures: Mapping[str, Mapping[str, Column]],
    at: str,
    before: DataFrame | None = None,
    since: Column | None = None,
) -> DataFrame:
    """As :func:`similar_totals`, over what is known on the probe's day ``at``.

    Sums run in two levels: along the months of a label subset, and along the days of one month, which begin
    with what the months before have left. So a window holds the days of one month or a row for each month, however
    long the history is. With ``before``, the stored :func:`monthly_totals` of the months before that of ``since`` (a first
    of a month), only what becomes known from ``since`` on is taken from ``cases``, and only probes from then on may be asked.
    """
    keys = [*group, *labels, at]
    names = [n for some in measures.values() for n in some]
    none = F.lit(0).cast("long")
    spread = [*group, "subset", "kept"]
    daily = daily_totals(cases, group=group, labels=labels, measures=measures)
    if since is not None:
        daily = daily.filter(F.col("_day") >= since)
    months = monthly_totals(daily, group=group, labels=labels, names=names)
    if before is not None:
        months = months.unionByName(before.select(months.columns))
    asked = probes.select(*keys).select(
        "*", F.inline(_subsets(labels)), F.col(at).alias("_day"), F.lit(True).alias("_asked"),
        *[none.alias(n) for n in names],
    ).withColumn("_month", month_of(F.col("_day")))
    given = (
        daily.select(*group, F.inline(_subsets(labels)), "_day", *names)
        .groupBy(*spread, "_day").agg(*[F.sum(n).alias(n) for n in names])
        .withColumns({"_asked": F.lit(False), "_month": month_of(F.col("_day"))})
    )
    # what each asked month begins with
    by_month = (
        months.select(*group, F.inline(_subsets(labels)), F.col("known_month").alias("_month"), *names)
        .groupBy(*spread, "_month").agg(*[F.sum(n).alias(n) for n in names])
    )
    earlier = Window.partitionBy(*spread).orderBy("_month").rangeBetween(Window.unboundedPreceding, -1)
    wanted = asked.select(*spread, "_month").distinct().select("*", *[none.alias(n) for n in names], F.lit(True).alias("_wanted"))
    start = (
        by_month.withColumn("_wanted", F.lit(False)).unionByName(wanted)
        .withColumns({n: F.coalesce(F.sum(n).over(earlier), none) for n in names}).filter("_wanted").drop("_wanted")
        # before the month's first day; a NULL day sorts first
        .withColumns({"_asked": F.lit(False), "_day": F.lit(None).cast(probes.schema[at].dataType)})
    )
    in_month = (
        Window.partitionBy(*spread, "_month").orderBy(F.col("_day").asc_nulls_first())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = asked.unionByName(given, allowMissingColumns=True).unionByName(start, allowMissingColumns=True).withColumns(
        {n: F.sum(n).over(in_month) for n in names}
    )
    weighted = [F.sum(F.col("weight") * F.col(n)).alias(n) for n in names]
    return running.filter("_asked").groupBy(*keys).agg(*weighted)
