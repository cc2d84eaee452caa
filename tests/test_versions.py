import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import DAY, bars, plan_of, same_rows
from tickloom import jobs
from tickloom.session import scratch_path
from tickloom.sources import tables
from tickloom.sources.versions import Conflict, VersionedTable, months_between


@pytest.fixture()
def table(spark):
    return VersionedTable(spark, scratch_path(spark, "versions"))


def monthly(spark, closes, **more):
    """One row each of January, February and so on."""
    return tables.by_month(bars(spark, [c for c in closes for _ in range(31)], **more).filter(F.day("date") == 5), "date")


def closes(df):
    return {(r.date.month, r.close) for r in df.collect()}


def test_a_commit_replaces_the_partitions_it_brings(spark, table):
    assert not table.exists() and table.version() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    table.commit(monthly(spark, [1, 2, 3]))
    old = table.read()
    table.commit(monthly(spark, [9]), removed=["202402"])
    assert closes(table.read()) == {(1, 9), (3, 3)}
    # earlier versions and frames still read their own state
    assert closes(table.read(1)) == closes(old) == {(1, 1), (2, 2), (3, 3)}
    table.commit(monthly(spark, [7]), whole=True)
    assert closes(table.read()) == {(1, 7)} and table.numbers() == [1, 2, 3]


@pytest.mark.parametrize("broken", ["write", "switch"])
def test_a_commit_that_breaks_off_changes_nothing(spark, table, monkeypatch, broken):
    table.commit(monthly(spark, [1, 2]))
    if broken == "switch":
        def stop(*_):
            raise KeyboardInterrupt

        monkeypatch.setattr(VersionedTable, "_switch", stop)
        with pytest.raises(KeyboardInterrupt):
            table.commit(monthly(spark, [8, 9]))
        monkeypatch.undo()
    else:
        bad = monthly(spark, [8, 9]).withColumn("close", F.when(F.month("date") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("close")))
        with pytest.raises(Exception, match="lost"):
            table.commit(bad)
    assert closes(table.read()) == {(1, 1), (2, 2)} and table.numbers() == [1]
    table.commit(monthly(spark, [8, 9]))
    assert closes(table.read()) == {(1, 8), (2, 9)}


def test_of_two_commits_on_one_version_the_second_fails(spark, table):
    first = table.commit(monthly(spark, [1]))
    table.commit(monthly(spark, [2]), base=first)
    with pytest.raises(Conflict):
        table.commit(monthly(spark, [3]), base=first)
    assert closes(table.read()) == {(1, 2)}


def test_two_first_commits_conflict(spark, table):
    """A base of None says that there was no version, so the second of two first commits fails too."""
    table.commit(monthly(spark, [1, 2]), base=None)
    with pytest.raises(Conflict):
        table.commit(monthly(spark, [3]), base=None)
    assert table.numbers() == [1] and table.read().count() == 2


def test_columns_come_and_go(spark, table):
    table.commit(monthly(spark, [1, 2]))
    table.commit(monthly(spark, [3]).drop("volume").withColumn("extra", F.lit("x")))
    got = {r.date.month: (r.close, r.volume, r.extra) for r in table.read().collect()}
    assert got == {1: (3.0, None, "x"), 2: (2.0, 100, None)}


def test_undivided_and_empty_tables(spark):
    table = VersionedTable(spark, scratch_path(spark, "whole"), None)
    table.commit(bars(spark, [1, 2]))
    table.commit(bars(spark, [5]), whole=True)
    assert [r.close for r in table.read().collect()] == [5]
    table.commit(bars(spark, [5]).limit(0), whole=True)
    assert table.read().count() == 0 and table.read().columns == bars(spark, [5]).columns


def test_rows_without_a_date_have_a_partition_of_their_own(spark, table):
    rows = tables.by_month(bars(spark, [1]).unionByName(bars(spark, [2]).withColumn("date", F.lit(None).cast("date"))), "date")
    table.commit(rows)
    assert same_rows(table.read(), rows)


def test_vacuum_removes_what_no_kept_version_names(spark, table, monkeypatch):
    for k in range(4):
        table.commit(monthly(spark, [k, k]))
    monkeypatch.setattr(VersionedTable, "_switch", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.commit(monthly(spark, [8, 9]))
    monkeypatch.undo()
    table.vacuum(keep=2)
    assert table.numbers() == [3, 4] and closes(table.read(3)) == {(1, 2), (2, 2)} and closes(table.read()) == {(1, 3), (2, 3)}
    left = spark.read.option("basePath", f"{table.path}/data").parquet(f"{table.path}/data")
    assert left.select("commit").distinct().count() == 2


def test_reads_open_the_months_asked_for(spark, table):
    table.commit(monthly(spark, [1, 2, 3]))
    df = table.read(wanted=months_between(dt.date(2024, 2, 1), dt.date(2024, 2, 9)))
    assert closes(df) == {(2, 2)} and len(df.inputFiles()) == 1
    assert table.read(wanted=lambda v: False).count() == 0
    assert "month" in plan_of(tables.in_months(table.read(), dt.date(2024, 2, 1))).split("PartitionFilters: ")[1].split("]")[0]


def test_a_window_whose_publishing_breaks_off_shows_the_old_state(spark, monkeypatch):
    path = scratch_path(spark, "serving")
    tables.publish_window(bars(spark, [1] * 40), path, "date", "2024-01-01", 40)
    before = tables.read_version(spark, path)
    monkeypatch.setattr(VersionedTable, "_switch", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tables.publish_window(bars(spark, [2] * 40), path, "date", "2024-01-20", 15)
    monkeypatch.undo()
    assert same_rows(tables.read_version(spark, path), before)
    tables.publish_window(bars(spark, [2] * 40), path, "date", "2024-01-20", 15)
    assert tables.read_version(spark, path).filter("close = 2").count() == 15


def test_a_merge_that_breaks_off_can_be_repeated(spark, monkeypatch):
    house = jobs.Warehouse(spark, scratch_path(spark, "house"))
    house.replace("silver_ohlcv", bars(spark, [1] * 40))
    rows = bars(spark, [2] * 10, start=DAY + dt.timedelta(days=27))
    monkeypatch.setattr(VersionedTable, "_switch", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        house.merge("silver_ohlcv", rows, jobs.DAY)
    monkeypatch.undo()
    assert house.read("silver_ohlcv").filter("close = 2").count() == 0
    for _ in range(2):
        house.merge("silver_ohlcv", rows, jobs.DAY, notes={"mark": "x"})
    assert house.read("silver_ohlcv").filter("close = 2").count() == 10 and house.read("silver_ohlcv").count() == 40
    assert house.note("silver_ohlcv", "mark") == "x" and house.note("none", "mark") is None
    house.vacuum(keep=1)
    assert house.read("silver_ohlcv").count() == 40
