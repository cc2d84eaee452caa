import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import DAY, bars, plan_of, same_rows
from tickloom import schemas
from tickloom.session import scratch_path, shared_dir, written
from tickloom.sources import tables
from tickloom.sources.deliveries import Deliveries
from tickloom.sources.ticks import decode_ticks
from tickloom.sources.versions import Conflict, VersionedTable
from tickloom.streaming import ticks as streamed
from tickloom.streaming.ticks import (
    bronze_stream, bronze_writer, compact_days, deduplicated, distinct_writer, dropped_rows, read_bronze, tick_stream,
)


@pytest.fixture()
def path(spark):
    return scratch_path(spark, "test")


def message(symbol="A", price=1.0, time="2024-01-01T10:00:00.000000Z", **more):
    return json.dumps({"symbol": symbol, "price": price, "volume": 5, "timestamp": time, **more})


def test_shared_dir_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == named.rstrip("/") if named else shared_dir(spark)


def test_written_table_reads_back(spark):
    df = bars(spark, [1, 2])
    assert same_rows(written(df, "test"), df)


def test_replace_partitions_leaves_the_others(spark, path):
    tables.replace_partitions(bars(spark, [1, 2, 3]), path, ["date"])
    tables.replace_partitions(bars(spark, [9], start=DAY + dt.timedelta(days=1)), path, ["date"])
    tables.replace_partitions(bars(spark, [9], start=DAY + dt.timedelta(days=1)), path, ["date"])
    got = [r.close for r in spark.read.parquet(path).orderBy("date").collect()]
    assert got == [1, 9, 3]


def test_bulk_load_truncates_or_adds(spark, path):
    tables.bulk_load(bars(spark, [1, 2, 3]), path, ["date"])
    tables.bulk_load(bars(spark, [1, 2]), path, ["date"])
    assert spark.read.parquet(path).count() == 2
    tables.bulk_load(bars(spark, [1, 2]), path, ["date"], truncate=False)
    assert spark.read.parquet(path).count() == 4


def test_append_merges_columns(spark, path):
    tables.append(bars(spark, [1]), path)
    tables.append(bars(spark, [2]).withColumn("extra", F.lit("x")), path)
    got = tables.read_merged(spark, path).orderBy("close").collect()
    assert [r.extra for r in got] == [None, "x"]


def test_publish_window_removes_days_that_are_gone(spark, path):
    tables.publish_window(bars(spark, [1] * 10), path, "date", "2024-01-01", 10)
    for _ in range(2):
        tables.publish_window(bars(spark, [2] * 10, skip=(3,)), path, "date", "2024-01-03", 3)
        got = {r.date.day: r.close for r in tables.read_version(spark, path).collect()}
        assert got == {1: 1, 2: 1, 3: 2, 5: 2, 6: 1, 7: 1, 8: 1, 9: 1, 10: 1}


def test_publish_all_skips_absent_tables(spark, path):
    bars(spark, [1, 2]).write.parquet(f"{path}/in/silver_ohlcv")
    counts = tables.publish_all(spark, f"{path}/in", f"{path}/out", only=["silver_ohlcv", "gold_52w_levels"])
    assert counts == {"silver_ohlcv": 2, "gold_52w_levels": None}
    skipped = tables.publish_windows(spark, f"{path}/in", f"{path}/out", "2024-01-01")
    assert "silver_ohlcv" not in skipped and "gold_technical_rating" in skipped
    assert tables.read_version(spark, f"{path}/out/silver_ohlcv").count() == 2
    assert tables.publish_all(spark, f"{path}/in", f"{path}/out", only=["silver_ohlcv"], truncate=False) == {"silver_ohlcv": 2}
    assert tables.read_version(spark, f"{path}/out/silver_ohlcv").count() == 4


def test_absent_table_reads_as_empty(spark, path):
    assert tables.read_if_present(spark, path, schemas.CASE_OUTCOMES).count() == 0


def test_create_table_if_absent(spark, path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS loom LOCATION '{path}'")
    try:
        for _ in range(2):
            tables.create_table_if_absent(spark, "loom.bronze_ticks", schemas.BRONZE_TICKS, ["symbol", "event_date"])
        assert spark.table("loom.bronze_ticks").count() == 0
        assert {f.name for f in spark.table("loom.bronze_ticks").schema} == set(schemas.BRONZE_TICKS.names)
    finally:
        spark.sql("DROP DATABASE loom CASCADE")


def test_decode_rejects_what_does_not_parse(spark):
    values = [message(), "{broken", message(symbol=None), message(price=None), message("B", time="never")]
    got = decode_ticks(spark.createDataFrame([(v.encode(),) for v in values], "value binary"))
    assert {(r.symbol, r.event_time) for r in got.collect()} == {
        ("A", dt.datetime(2024, 1, 1, 10)), ("B", None),
    }


def run_stream(spark, folder, path, state):
    messages = spark.readStream.text(folder)
    bronze_stream(messages, path, state, interval=None).start().awaitTermination()


def test_stream_continues_where_it_stopped(spark, path, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text(message("A") + "\n{broken\n")
    run_stream(spark, str(source), path, f"{path}-state")
    (source / "2.txt").write_text(message("B") + "\n")
    run_stream(spark, str(source), path, f"{path}-state")
    run_stream(spark, str(source), path, f"{path}-state")
    stored = read_bronze(spark, path)
    assert sorted(r.symbol for r in stored.collect()) == ["A", "B"]
    assert "ingestion_time" in stored.columns and "timestamp" not in stored.columns


def test_replayed_batch_is_stored_once(spark, path):
    batch = decode_ticks(spark.createDataFrame([(message(s).encode(),) for s in "AB"], "value binary"))
    write = bronze_writer(path, partition_by=("symbol", "event_date"), source_id="one")
    write(batch, 7)
    write(batch, 7)
    write(batch.limit(0), 8)
    assert read_bronze(spark, path).count() == 2
    write(batch, 9)
    assert read_bronze(spark, path).count() == 4
    with pytest.raises(ValueError, match="source_id"):
        bronze_writer(path)(batch, 1)


def test_a_new_checkpoint_overwrites_nothing(spark, path, tmp_path):
    """Batch ids start at 0 again; both streams write to one path and one day."""
    for k, names in enumerate(("AB", "CDE")):
        source = tmp_path / f"in{k}"
        source.mkdir()
        (source / "1.txt").write_text("\n".join(message(s) for s in names) + "\n")
        for _ in range(2):
            run_stream(spark, str(source), path, f"{path}-state{k}")
    stored = read_bronze(spark, path)
    assert sorted(r.symbol for r in stored.collect()) == list("ABCDE")
    assert stored.select("source_id").distinct().count() == 2


def test_closed_days_are_brought_together(spark, path):
    rows = [message(s, time=f"2024-01-0{d}T10:00:00.000000Z") for s in "ABC" for d in (1, 2, 3)]
    batch = decode_ticks(spark.createDataFrame([(r.encode(),) for r in rows], "value binary"))
    write = bronze_writer(path, source_id="s")
    write(batch, 0)
    write(batch.filter("symbol = 'A'"), 1)
    before = read_bronze(spark, path)
    want = written(before, "before")
    for _ in range(2):
        compact_days(spark, path, dt.date(2024, 1, 3), buckets=2)
        assert same_rows(read_bronze(spark, path).select(want.columns), want)
    days = VersionedTable(spark, f"{path}/days", "event_date").read()
    assert {str(r[0]) for r in days.select("event_date").distinct().collect()} == {"2024-01-01", "2024-01-02"}
    live = spark.read.parquet(f"{path}/live")
    assert {str(r[0]) for r in live.select("event_date").distinct().collect()} == {"2024-01-03"}
    # a late tick of a closed day, and a delivery whose removal had failed: stored in both parts
    write(batch.filter("symbol = 'B' AND event_date = '2024-01-01'"), 2)
    write(batch.filter("event_date = '2024-01-02'"), 0)
    assert read_bronze(spark, path).count() == want.count() + 1
    compact_days(spark, path, dt.date(2024, 1, 3))
    assert read_bronze(spark, path).count() == want.count() + 1


def day_batch(spark, days=(1, 2, 3), names="ABC"):
    rows = [message(s, time=f"2024-01-0{d}T10:00:00.000000Z") for s in names for d in days]
    return decode_ticks(spark.createDataFrame([(r.encode(),) for r in [*rows, message("X", time="never")]], "value binary"))


@pytest.mark.parametrize("broken", ["commit", "remove"])
@pytest.mark.parametrize("parts", [("event_date",), ("symbol", "event_date")])
def test_a_compaction_that_breaks_off_loses_and_doubles_nothing(spark, path, monkeypatch, broken, parts):
    """After the days were moved, or after they were committed; deliveries are replayed and added in between."""
    write, until = bronze_writer(path, parts, source_id="s"), dt.date(2024, 1, 3)

    def ids():
        got = read_bronze(spark, path).collect()
        return sorted((r.batch_id, r.symbol, str(r.event_date)) for r in got)

    def fail(*args, **more):
        raise RuntimeError("lost")

    write(day_batch(spark), 0)
    write(day_batch(spark, names="A"), 1)
    compact_days(spark, path, dt.date(2024, 1, 2))
    want = ids()
    assert len(want) == 9 + 3 + 2
    with monkeypatch.context() as m:
        if broken == "commit":
            m.setattr(VersionedTable, "commit", fail)
        else:
            m.setattr(streamed, "remove", fail)
        with pytest.raises(RuntimeError, match="lost"):
            compact_days(spark, path, until)
    assert ids() == want
    write(day_batch(spark), 0)  # replayed: days that were compacted, moved and live
    assert ids() == want
    write(day_batch(spark, days=(1, 2), names="B"), 2)
    want = sorted([*want, (2, "B", "2024-01-01"), (2, "B", "2024-01-02"), (2, "X", "None")])
    assert ids() == want
    for _ in range(2):
        compact_days(spark, path, until)
        assert ids() == want
    assert not streamed._folders(spark, path, "closed/run=*")
    streamed.compacted_days(spark, path).vacuum(1)
    assert ids() == want


def test_a_compaction_handles_days_not_batches(spark, path, monkeypatch):
    """However many batches a day has, its folder is moved once and removed once."""
    write, removed = bronze_writer(path, source_id="s"), []
    for k in range(6):
        write(day_batch(spark, names="A"), k)
    real = streamed.remove
    monkeypatch.setattr(streamed, "remove", lambda s, p: (removed.append(p), real(s, p)))
    compact_days(spark, path, dt.date(2024, 1, 3))
    assert len(removed) == 2 and not streamed._folders(spark, path, "closed/run=*")
    table = VersionedTable(spark, f"{path}/days", "event_date")
    assert table.numbers() == [1] and sorted(table.version().parts) == ["2024-01-01", "2024-01-02"]
    assert table.read().count() == 12


def test_the_later_of_two_compactions_fails_and_loses_nothing(spark, path, monkeypatch):
    write = bronze_writer(path, source_id="s")
    write(day_batch(spark), 0)
    real = VersionedTable.commit

    def overtaken(self, rows, **more):
        real(self, rows, **more)
        return real(self, rows, **more)

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", overtaken)
        with pytest.raises(Conflict):
            compact_days(spark, path, dt.date(2024, 1, 3))
    assert read_bronze(spark, path).count() == 10
    compact_days(spark, path, dt.date(2024, 1, 3))
    assert read_bronze(spark, path).count() == 10


def test_bronze_without_rows_and_other_partitions(spark, path):
    assert read_bronze(spark, path) is None
    compact_days(spark, path, dt.date(2024, 1, 3))
    bronze_writer(path, source_id="s")(day_batch(spark).limit(0), 0)
    assert read_bronze(spark, path) is None
    with pytest.raises(ValueError, match="partitioned"):
        bronze_writer(path, ("event_date", "price"))


def test_stream_dedup(spark, tmp_path, path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text("\n".join([message("A"), message("A", price=2.0), message("B")]) + "\n")
    ticks = deduplicated(tick_stream(spark.readStream.text(str(source))))
    query = (
        ticks.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.symbol for r in spark.read.parquet(path).collect()) == ["A", "B"]


@pytest.mark.parametrize(("delay", "kept", "dropped"), [("10 seconds", 3, 2), ("2 days", 5, 0)])
def test_lateness_decides_what_a_stream_dedup_keeps(spark, tmp_path, path, delay, kept, dropped):
    """One file per micro-batch; the last two ticks are an hour or more behind."""
    source = tmp_path / "in"
    source.mkdir()
    times = ["10:00:00", "10:00:00", "11:00:00", "12:00:00", "10:30:00", "09:00:00"]
    for k, t in enumerate(times):
        (source / f"{k}.txt").write_text(message("A", time=f"2024-01-01T{t}.000000Z") + "\n")
        os.utime(source / f"{k}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
    messages = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
    query = (
        deduplicated(tick_stream(messages, delay)).writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(path).count() == kept
    assert dropped_rows(query.recentProgress) == dropped


def test_distinct_writer_finds_repeats_however_late(spark, path):
    """Batches spread over a year, in no order; NULL times, repeats within and between batches, a replay."""
    times = [None, *[f"2024-{m:02d}-01T10:00:00.000000Z" for m in range(1, 13)]]
    rows = [(message(s, time=t) if t else message(s, time="never")).encode() for s in "AB" for t in times]
    ticks = decode_ticks(spark.createDataFrame([(r,) for r in rows], "value binary"))
    write = distinct_writer(path, source_id="s")
    month = F.coalesce(F.month("event_time"), F.lit(0))
    for k, part in enumerate((month % 3 == 0, month % 2 == 0, month >= 0, month == 1)):
        for _ in range(2):
            write(ticks.filter(part).unionByName(ticks.filter(part)), k)
    stored = spark.read.parquet(path)
    want = ticks.select("symbol", "event_time").distinct()
    assert same_rows(stored.select("symbol", "event_time"), want) and stored.count() == len(rows)


def test_a_delivery_is_opened_once(spark, path):
    log = Deliveries(spark, path)
    assert log.after(0) == (None, 0)
    for k in range(3):
        assert log.add(bars(spark, [k] * 3)) == k + 1
    rows, last = log.after(1)
    assert last == 3 and sorted(r.close for r in rows.collect()) == [1, 1, 1, 2, 2, 2]
    assert "delivered" in plan_of(rows).split("PartitionFilters: ")[1].split("]")[0] and len(rows.inputFiles()) == 2
    assert log.after(3) == (None, 3)
    log.forget(2)
    log.table.vacuum(1)
    assert log.last() == 3 and [r.close for r in log.after(0)[0].collect()] == [2, 2, 2]
    assert log.add(bars(spark, [9])) == 4
