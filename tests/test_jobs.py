import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, same_rows
from tickloom import jobs
from tickloom.plans import silver
from tickloom.session import scratch_path, written
from tickloom.sources import tables

TABLES = [
    "silver_ohlcv", "gold_volatility_index", "gold_52w_levels", "gold_technical_rating",
    "gold_anomaly_flags", "gold_sector_performance", "decision_cf_engine",
    "decision_metarule_flags", "decision_signals",
]


@pytest.fixture(scope="module")
def bronze(inputs):
    """Bars of one region, to keep the many small writes quick."""
    few = inputs.symbols.filter("sector = 'AFRICA'")
    bars = inputs.bars.join(few.select("symbol"), "symbol", "left_semi").filter("date BETWEEN '1996' AND '1998'")
    return written(bars, "test-bronze"), few


def test_refresh_equals_build(spark, inputs, bronze):
    """A second delivery that brings new days and, for one symbol, an old one."""
    bars, symbols = bronze
    first = bars.agg(F.min("symbol")).first()[0]
    late = (F.col("symbol") == first) & (F.col("date").between("1996-03-01", "1996-03-10"))
    new = late | (F.col("date") >= "1997-10-01")
    delivered = bars.withColumn(
        "ingestion_time",
        F.when(new, F.col("ingestion_time") + F.expr("interval 3000 days")).otherwise(F.col("ingestion_time")),
    )
    full = jobs.Warehouse(spark, scratch_path(spark, "full"))
    jobs.build_tables(full, delivered, symbols, inputs.rules)
    grown = jobs.Warehouse(spark, scratch_path(spark, "grown"))
    jobs.build_tables(grown, delivered.filter(~new), symbols, inputs.rules)
    assert not same_rows(grown.read("decision_signals"), full.read("decision_signals"))
    for _ in range(2):  # the second run finds nothing new
        jobs.refresh_tables(grown, delivered)
    for name in TABLES:
        assert same_rows(grown.read(name), full.read(name)), name

    # day by day, the short way: ends as one run over the whole history
    today = dt.date(1997, 12, 20)
    jobs.record_outcomes(grown, dt.date(1997, 11, 1), oldest=None)
    for day in (dt.date(1997, 11, 20), dt.date(1997, 12, 8), today):
        jobs.record_outcomes(grown, day)
    for _ in range(2):
        jobs.record_outcomes(full, today, oldest=None)
    assert same_rows(grown.read("decision_case_outcomes"), full.read("decision_case_outcomes"))
    assert same_rows(grown.read("decision_cbr_lookup"), full.read("decision_cbr_lookup"))
    assert same_rows(grown.read("decision_validation"), full.read("decision_validation"))
    assert "recorded_at" in full.read("decision_case_outcomes", stamps=True).columns
    assert "detected_at" in full.read("gold_anomaly_flags", stamps=True).columns
    outcomes = full.read("decision_case_outcomes")
    assert outcomes.count() > 100
    report = jobs.check_tables(full)
    assert report.filter("status <> 'pass'").collect() == []
    assert {r.table_name for r in report.select("table_name").collect()} >= {*TABLES, "decision_case_outcomes"}
    assert outcomes.groupBy("symbol", "signal_date").count().filter("count > 1").isEmpty()
    assert full.read("decision_cbr_lookup").count() == full.read("decision_signals").count()
    assert full.read("decision_validation").agg(F.sum("total_signals")).first()[0] == outcomes.count()

    jobs.score_outliers(full, "1997-01-01")
    kinds = {r[0] for r in full.read("gold_batch_anomalies").select("anomaly_type").distinct().collect()}
    assert kinds == {"isolation_forest", "volume_zscore", "price_iqr"}


def test_reads_are_pruned_to_months(spark, bronze):
    house = jobs.Warehouse(spark, scratch_path(spark, "pruned"))
    house.replace("bars", bronze[0])
    plan = plan_of(house.read("bars", dt.date(1997, 3, 5), dt.date(1997, 4, 1)))
    assert "PartitionFilters: [isnotnull(month" in plan and "month#" in plan
    got = house.read("bars", dt.date(1997, 3, 5), dt.date(1997, 4, 1)).select(F.trunc("date", "month")).distinct().collect()
    assert {str(r[0]) for r in got} == {"1997-03-01", "1997-04-01"}


def test_ticks_refresh_equals_build(spark, inputs):
    """A second delivery with new days and late ticks of an old one; the serving copy gets the sessions."""
    cut = F.lit("2024-01-20").cast("date")
    late = (F.col("event_date") == "2024-01-05") & (F.hash("event_time") % 3 == 0)
    new = late | (F.col("event_date") >= cut)
    ticks = written(inputs.ticks.withColumn(
        "ingestion_time", F.when(new, F.col("ingestion_time") + F.expr("interval 100 days")).otherwise(F.col("ingestion_time"))), "ticks")
    full, grown = (jobs.Warehouse(spark, scratch_path(spark, n)) for n in ("full-ticks", "grown-ticks"))
    jobs.build_ticks(full, ticks, inputs.tick_symbols)
    jobs.build_ticks(grown, ticks.filter(~new), inputs.tick_symbols)
    assert not same_rows(grown.read("gold_intraday_vwap"), full.read("gold_intraday_vwap"))
    for _ in range(2):
        jobs.refresh_ticks(grown, ticks)
    for name in ("silver_ticks", "gold_intraday_vwap"):
        assert same_rows(grown.read(name), full.read(name)), name
    counts = tables.publish_all(spark, full.folder, full.path("serving"), only=["gold_intraday_vwap"])
    assert counts["gold_intraday_vwap"] == full.read("gold_intraday_vwap").count() > 0


def test_wide_bars_reach_bronze(spark):
    wide = spark.createDataFrame(
        [("2024-01-01", 1.0, 2.0, 0.5, 1.5, 10, None), ("2024-01-02", 2.0, 3.0, 1.5, 2.5, None, None)],
        "Date string, A_Open double, A_High double, A_Low double, A_Close double, A_Volume long, B_Open double")
    house = jobs.Warehouse(spark, scratch_path(spark, "bars"))
    jobs.ingest_bars(house, wide, spark.createDataFrame([("A",)], "symbol string"))
    jobs.ingest_bars(house, wide.filter("Date = '2024-01-02'").withColumn("A_Close", F.lit(9.0)), ["A"])
    got = house.read("bronze_daily_ohlcv").orderBy("date").collect()
    assert [(r.symbol, r.date, r.close, r.volume) for r in got] == [("A", "2024-01-01", 1.5, 10), ("A", "2024-01-02", 9.0, 0)]
    assert silver.silver_ohlcv(house.read("bronze_daily_ohlcv")).count() == 1


def test_checks_tell_what_is_wrong(spark):
    house = jobs.Warehouse(spark, scratch_path(spark, "checked"))
    kinds = "symbol string, date date, high_52w double, low_52w double"
    day = dt.date(2024, 1, 31)
    rows = [("A", day, 1.0, 1.0), ("A", day, 2.0, None), ("B", day, 1.0, 1.0), (None, dt.date(2023, 1, 1), 1.0, 1.0)]
    house.replace("gold_52w_levels", spark.createDataFrame(rows, kinds))
    bars = spark.createDataFrame(
        [("A", day, 1.0, 1.0, 1.0, 1.0, 5, dt.datetime(2024, 1, 31, 12))],
        "symbol string, date date, open double, high double, low double, close double, volume long, ingestion_time timestamp")
    house.replace("silver_ohlcv", bars)

    def wrong(**options):
        return {(r.table_name, r.test, r.subject): r.failures
                for r in jobs.check_tables(house, **options).filter("status <> 'pass'").collect()}

    found = {("gold_52w_levels", "not_null", "low_52w"): 1, ("gold_52w_levels", "unique", "symbol,date"): 2}
    assert wrong(since=day, now=dt.datetime(2024, 2, 1, 12)) == found
    assert wrong(now=dt.datetime(2024, 2, 1, 14)) == found | {
        ("gold_52w_levels", "not_null", "symbol"): 1, ("silver_ohlcv", "freshness", "ingestion_time"): 1}
    stored = spark.read.parquet(house.path("quality_reports"))
    assert stored.select("checked_at").distinct().count() == 2


def test_a_check_reads_its_table_once(spark):
    """All tests of a contract come from one scan and one grouping by key; an empty table passes but for its age."""
    from tickloom.plans import checks

    path = scratch_path(spark, "scanned")
    stamp = dt.datetime(2024, 1, 31, 12)
    rows = [("A", stamp, 1.0, 5, "live"), ("A", stamp, 1.0, None, "odd"), ("A", stamp, None, 5, None), (None, stamp, 1.0, 5, "live")]
    ticks = spark.createDataFrame(rows, "symbol string, event_time timestamp, price double, volume long, session_status string")
    ticks.withColumn("ingestion_time", F.col("event_time")).write.parquet(path)
    contract = checks.CONTRACTS["silver_ticks"]
    report = checks.table_report("ticks", spark.read.parquet(path), contract, "2024-02-03 13:00:00")
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [(r.test, r.subject, r.failures, r.status) for r in report.collect()] == [
        ("not_null", "symbol", 1, "error"), ("not_null", "event_time", 0, "pass"), ("not_null", "price", 1, "error"),
        ("not_null", "volume", 1, "error"), ("unique", "symbol,event_time", 3, "error"),
        ("accepted_values", "session_status", 1, "error"), ("freshness", "ingestion_time", 1, "error")]
    empty = checks.table_report("ticks", spark.read.parquet(path).limit(0), contract, "2024-02-03 13:00:00")
    assert {r.test: r.failures for r in empty.collect()} == {
        "not_null": 0, "unique": 0, "accepted_values": 0, "freshness": 1}
