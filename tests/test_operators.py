import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import DAY, bars, plan_of, same_rows
from tickloom.operators import quality
from tickloom.operators.forest import expected_depth, isolation_scores, with_isolation_score
from tickloom.operators.similarity import similar_totals, similar_totals_known
from tickloom.plans import detectors

LABELS = ["a", "b", "c", "d", "e"]


def random_cases(spark, count, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice("XY"), *[rng.choice("pqr") for _ in LABELS], DAY + dt.timedelta(days=rng.randrange(30)),
         rng.randrange(-50, 50))
        for _ in range(count)
    ]
    columns = "g string, a string, b string, c string, d string, e string, day date, v bigint"
    return rows, spark.createDataFrame(rows, columns)


def alike(left, right):
    return left[0] == right[0] and sum(x == y for x, y in zip(left[1:6], right[1:6])) >= 3


def test_similar_totals_equal_brute_force(spark):
    probe_rows, probes = random_cases(spark, 60, 1)
    case_rows, cases = random_cases(spark, 200, 2)
    got = {
        tuple(r[k] for k in ["g", *LABELS]): (r.n, r.v)
        for r in similar_totals(probes, cases, group=["g"], labels=LABELS,
                                measures={"n": F.lit(1).cast("bigint"), "v": F.col("v")}).collect()
    }
    for probe in probe_rows:
        hits = [c for c in case_rows if alike(probe, c)]
        expected = (len(hits), sum(c[7] for c in hits))
        assert got.get(tuple(probe[:6]), (0, 0)) == expected


def test_known_totals_use_only_the_past(spark):
    probe_rows, probes = random_cases(spark, 60, 3)
    case_rows, cases = random_cases(spark, 200, 4)
    got = {
        (tuple(r[k] for k in ["g", *LABELS]), r.day): (r.n, r.v)
        for r in similar_totals_known(
            probes.dropDuplicates(["g", *LABELS, "day"]),
            cases.withColumns({"from": F.col("day"), "later": F.when(F.col("v") % 3 != 0, F.date_add("day", 4))}),
            group=["g"], labels=LABELS, at="day",
            measures={"from": {"n": F.lit(1).cast("bigint")}, "later": {"v": F.col("v")}},
        ).collect()
    }
    for probe in probe_rows:
        hits = [c for c in case_rows if alike(probe, c) and c[6] <= probe[6]]
        late = [c for c in hits if c[7] % 3 and c[6] + dt.timedelta(days=4) <= probe[6]]
        assert got[(tuple(probe[:6]), probe[6])] == (len(hits), sum(c[7] for c in late))


def test_subset_weights_count_each_case_once():
    for agreeing in range(6):
        weight = sum(
            w * sum(1 for s in itertools.combinations(range(5), size) if set(s) <= set(range(agreeing)))
            for size, w in {3: 1, 4: -3, 5: 6}.items()
        )
        assert weight == (1 if agreeing >= 3 else 0)


def test_forest_ranks_planted_outliers_first():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    x[:4] += 9
    scores = isolation_scores(x, [42, 1], trees=100, sample=256)
    assert set(np.argsort(-scores)[:4]) == {0, 1, 2, 3}
    assert scores.min() > 0 and scores.max() <= 1
    again = isolation_scores(x, [42, 1], trees=100, sample=256)
    assert np.array_equal(scores, again)
    # scaling the features does not change what is easy to isolate
    scaled = isolation_scores(x * [1, 100, 0.01] + [5, 0, -3], [42, 1], trees=100, sample=256)
    assert np.allclose(scores, scaled)


def test_forest_of_equal_rows():
    scores = isolation_scores(np.ones((80, 3)), [42, 1], trees=10, sample=256)
    assert np.allclose(scores, scores[0])


def test_expected_depth():
    assert expected_depth(np.array([0, 1, 2])).tolist() == [0, 0, 1]
    assert expected_depth(np.array([256]))[0] == pytest.approx(10.24, abs=0.01)


def test_forest_does_not_depend_on_partitioning(spark):
    rows = [("A" if k < 100 else "B", k, float((k * 37) % 101), float((k * 53) % 17)) for k in range(150)]
    df = spark.createDataFrame(rows, "g string, k int, x double, y double")

    def run(frame):
        out = with_isolation_score(frame, group=["g"], order="k", features=["x", "y"], trees=20)
        return {(r.g, r.k): r.isolation for r in out.collect()}

    first = run(df)
    assert run(df.repartition(5).orderBy(F.desc("k"))) == first
    assert {g for g, _ in first} == {"A"}  # B has fewer rows than a forest needs


def test_forest_verdicts(inputs):
    features = detectors.ml_features(inputs.volatility)
    verdicts = detectors.isolation_forest(features)
    r = verdicts.agg(
        F.min("score").alias("low"), F.max("score").alias("high"), F.count("*").alias("n"),
        F.avg(F.col("is_anomaly").cast("double")).alias("share"),
    ).first()
    assert 0 <= r.low and r.high <= 1 and r.n > 1000 and 0.01 < r.share < 0.12
    assert verdicts.groupBy("symbol", "date").count().filter("count > 1").isEmpty()


def test_single_run_is_part_of_all_runs(inputs):
    one = detectors.run_features(inputs.volatility, "1998-07-01")
    every = detectors.ml_features(inputs.volatility).filter("window_start = DATE '1998-07-01'")
    assert one.count() > 0
    assert one.exceptAll(every.select(one.columns)).isEmpty()
    assert every.select(one.columns).exceptAll(one).isEmpty()


def test_zscore_needs_five_rows(spark):
    days = [DAY + dt.timedelta(days=k) for k in range(5)]
    rows = [(DAY, "A", d, True, v) for d, v in zip(days, [1, 1, 1, 1, 90])]
    features = spark.createDataFrame(
        rows, "window_start date, symbol string, date date, is_scored boolean, volume bigint"
    )
    scores = [r.score for r in detectors.batch_volume_zscore(features).orderBy("date").collect()]
    assert scores[:4] == [0, 0, 0, 0] and scores[4] > 0


def test_quality_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("z", 3)], "k string, v int")
    assert {r.column_name: r.failures for r in quality.not_null(df, ["k", "v"]).collect()} == {"k": 0, "v": 1}
    r = quality.unique(df, ["k"]).first()
    assert (r.key, r.repeated_keys, r.rows_involved) == ("k", 1, 2)
    assert quality.accepted_values(df, "k", ["a"]).first().value == "z"
    stamped = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS t")
    for now, status in [("2024-01-01 10:00:00", "pass"), ("2024-01-02 10:00:00", "warn"), ("2024-01-04", "error")]:
        assert quality.freshness(stamped, "t", now, 24, 48).first().status == status
    assert quality.freshness(stamped.limit(0), "t", "2024-01-01", 24).first().status == "error"


def test_forest_agrees_with_a_plain_recursive_one():
    """Own random numbers on both sides, so the scores agree up to the noise of so many trees."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 2)) * [1, 5]
    x[:3] += 12
    trees, sample = 400, 64

    def depth(point, rows, level):
        if level == 6 or len(rows) <= 1 or (rows == rows[0]).all():
            return level + float(expected_depth(np.array([len(rows)]))[0])
        f = rng.choice([k for k in range(2) if rows[:, k].min() < rows[:, k].max()])
        cut = rng.uniform(rows[:, f].min(), rows[:, f].max())
        side = rows[:, f] > cut
        return depth(point, rows[side if point[f] > cut else ~side], level + 1)

    some = [0, 1, 2, 50, 80, 120]
    plain = [
        2 ** (-np.mean([depth(x[k], x[rng.permutation(150)[:sample]], 0) for _ in range(trees)])
              / float(expected_depth(np.array([sample]))[0]))
        for k in some
    ]
    got = isolation_scores(x, [1, 2], trees=trees, sample=sample)[some]
    assert np.abs(got - plain).max() < 0.03


def test_blocks_keep_rows_without_a_key_or_a_date(spark):
    from tickloom.operators.series import with_series

    none = bars(spark, [5, 6]).withColumn("symbol", F.lit(None).cast("string"))
    undated = bars(spark, [7], symbol="B").withColumn("date", F.lit(None).cast("date"))
    df = bars(spark, range(1, 9)).unionByName(none).unionByName(undated)
    stage = lambda over: {"mean": F.avg("close").over(over(3))}
    plain = with_series(df, [stage], lookback=2)
    assert same_rows(with_series(df, [stage], lookback=2, block_rows=3), plain) and plain.count() == 11


def test_blocks_are_chosen_from_counted_rows(spark):
    """One key with most rows, packed into one hour; NULL keys and times among the rest."""
    from tickloom.operators.series import series_blocks, with_series

    hot = spark.range(600).selectExpr(
        "'H' AS symbol", "timestamp'2024-05-06 10:00:00' + make_dt_interval(0, 0, 0, id) AS t", "CAST(id % 7 AS double) AS v")
    thin = spark.range(40).selectExpr(
        "IF(id % 4 = 0, NULL, 'T') AS symbol",
        "IF(id = 39, NULL, timestamp'2020-01-01 00:00:00' + make_dt_interval(CAST(id AS int) * 30)) AS t", "CAST(id AS double) AS v")
    df = hot.unionByName(thin)
    assert series_blocks(df, order="t", most=600) == {}
    assert series_blocks(df.limit(0), order="t") == {}
    assert series_blocks(df, order="t", most=599) == {"block_rows": 599, "slice_by": "hour"}
    # 600 rows over ten hours of a day, over days of a month, over months of a year, over years
    for step, unit in ((60, "hour"), (1440, "day"), (3 * 1440, "month"), (30 * 1440, "year")):
        spread = df.withColumn("t", F.expr(
            f"IF(symbol = 'H', timestamp'2000-01-01 00:00:00' + make_dt_interval(0, 0, v * 0 + {step} * CAST(unix_timestamp(t) % 600 AS int)), t)"))
        chosen = series_blocks(spread, order="t", most=13)
        assert chosen == {"block_rows": 13, "slice_by": unit}, (step, chosen)
    stage = lambda over: {"mean": F.avg("v").over(over(4))}
    plain = with_series(df, [stage], order="t", lookback=3)
    for most in (5, 100, 599):
        sized = series_blocks(df, order="t", most=most)
        assert sized and same_rows(with_series(df, [stage], order="t", lookback=3, **sized), plain)


@pytest.mark.parametrize("slice_days", [1, 7, 24, 1000])
def test_forward_values_by_slices(spark, slice_days):
    """One symbol with all rows in many windows; gaps, NULL values, days before 1970, an event without a date."""
    from tickloom.operators.asof import with_forward_value

    pick = random.Random(slice_days)
    start = dt.date(1969, 11, 1)
    prices = {k: pick.choice([None, float(k)]) for k in range(200) if pick.random() < 0.6}
    series = spark.createDataFrame([("A", start + dt.timedelta(days=k), v) for k, v in prices.items()], "symbol string, date date, close double")
    events = spark.createDataFrame([("A", start + dt.timedelta(days=k), k) for k in range(-30, 210)] + [("A", None, 999)], "symbol string, date date, k int")
    windows = {"near": (-2, 3), "far": (20, 24)}
    found = with_forward_value(events, series, value="close", windows=windows, dates=True, slice_days=slice_days)
    assert "hashpartitioning(symbol" in plan_of(found) and "_slice" in plan_of(found).split("hashpartitioning(symbol")[1].split(")")[0]
    got = {r.k: (r.near, r.far, r.far_date) for r in found.collect()}
    assert got.pop(999) == (None, None, None) and len(got) == 240
    for k, (near, far, far_date) in got.items():
        first = [next((d for d in range(k + low, k + high + 1) if prices.get(d) is not None), None) for low, high in windows.values()]
        assert (near, far) == tuple(None if d is None else prices[d] for d in first)
        assert far_date == (None if first[1] is None else start + dt.timedelta(days=first[1]))


def _points(spark, n, group="A"):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 2)).round(3)
    rows = [(group, k, float(a), float(b)) for k, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "g string, k int, x double, y double"), x


def test_forest_scores_by_blocks(spark):
    """Blocks of a group change no score, and a group no larger than the pool is scored as by one numpy forest."""
    import zlib

    df, x = _points(spark, 700)
    nulls = spark.createDataFrame([("A", 900, None, 1.0), (None, 901, 1.0, 2.0)], df.schema)
    settings = dict(group=["g"], order="k", features=["x", "y"], trees=20)
    plain = isolation_scores(x, [42, zlib.crc32(b"A")], trees=20, sample=256)
    for block_rows in (50, 65536):
        scored = with_isolation_score(df.unionByName(nulls), block_rows=block_rows, **settings)
        got = {r.k: r.isolation for r in scored.collect()}
        assert sorted(got) == list(range(700)) and [got[k] for k in range(700)] == plain.tolist()
    assert with_isolation_score(df.limit(0), **settings).isEmpty()


def test_forest_of_a_group_larger_than_its_pool(spark):
    """Every row is scored, by trees from the pool alone; the outliers still lead."""
    from tickloom.operators.forest import grown_forests

    df, _ = _points(spark, 3000)
    far = spark.createDataFrame([("A", 5000 + k, 9.0 + k, -9.0) for k in range(4)], df.schema)
    settings = dict(group=["g"], order="k", features=["x", "y"], trees=50, sample=128, pool_rows=512)
    both = df.unionByName(far)
    one = grown_forests(both, **settings).collect()
    assert len(one) == 1 and set(one[0].held[:50]) == {128}
    scored = with_isolation_score(both.repartition(7), block_rows=300, **settings)
    assert "_block" in plan_of(scored)
    rows = sorted(scored.collect(), key=lambda r: -r.isolation)
    assert len(rows) == 3004 and len({r.k for r in rows[:12]} & {5000, 5001, 5002, 5003}) == 4
    again = {r.k: r.isolation for r in with_isolation_score(both, block_rows=10**6, **settings).collect()}
    assert again == {r.k: r.isolation for r in rows}
    with pytest.raises(ValueError):
        grown_forests(both, **{**settings, "pool_rows": 100})


def test_forest_reads_its_input_once(spark, inputs):
    """The group's exchange is shared by pools, marks and blocks when the query runs."""
    scored = detectors.forest_scores(detectors.ml_features(inputs.volatility), trees=5)
    scored.collect()
    final = scored._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final or "reuse" in final.lower()
