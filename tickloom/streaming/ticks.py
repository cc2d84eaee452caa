"""Ticks from a message stream into the bronze table."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tickloom.session import written
from tickloom.sources.tables import remove, replace_partitions, table_exists
from tickloom.sources.ticks import decode_ticks
from tickloom.sources.versions import VersionedTable

WATERMARK_DELAY = "10 seconds"
TRIGGER_INTERVAL = "10 seconds"


def tick_stream(messages: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Decoded ticks with a watermark on their event time.

    Nothing stateful follows, so the watermark drops no rows here; it is there
    for steps like :func:`deduplicated` that keep state.
    """
    return decode_ticks(messages).withWatermark("event_time", delay)


def dropped_rows(progress: Sequence) -> int:
    """How many rows came behind the watermark and were dropped, by a query's ``recentProgress``."""
    told = (json.loads(p.json) if hasattr(p, "json") else p for p in progress)
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in told for s in p["stateOperators"])


def deduplicated(ticks: DataFrame) -> DataFrame:
    """First tick of each symbol and event time, remembered for the length of the watermark.

    The watermark's delay must be as long as ticks can come late: a tick behind it is
    dropped, which :func:`dropped_rows` tells. :func:`distinct_writer` needs no such guess.
    """
    return ticks.dropDuplicatesWithinWatermark(["symbol", "event_time"])


KEY = ("symbol", "event_time")


def distinct_writer(
    path: str, keys: Sequence[str] = KEY, day: str = "event_date", source_id: str | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that stores the rows of a micro-batch whose keys no earlier batch has brought.

    What is remembered is the table itself, so a repeat is found however late it comes, without a watermark, a guess at
    the lateness or state that grows. Only the partitions of the batch's own days are read. ``day`` must follow from the
    keys. A batch replayed after a failure meets the other batches' keys only and overwrites its own rows. NULL keys are
    keys like others.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        source = source_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not source:
            raise ValueError("a batch outside a streaming query needs a source_id")
        rows = written(batch.dropDuplicates(list(keys)), "batch")
        if table_exists(spark, path):
            days = [r[0] for r in rows.select(day).distinct().collect()]  # of one micro-batch
            same_day = F.col(day).isin([d for d in days if d is not None])
            if None in days:
                same_day = same_day | F.col(day).isNull()
            # with its columns given, nothing is inferred from what other batches hold
            kind = T.StructType([*rows.schema.fields, T.StructField("source_id", T.StringType()), T.StructField("batch_id", T.LongType())])
            stored = spark.read.schema(kind).parquet(path).filter(same_day)
            others = stored.filter((F.col("source_id") != source) | (F.col("batch_id") != batch_id))
            seen = others.select(*[F.col(k).alias(f"_of_{k}") for k in keys])
            rows = rows.join(seen, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], "left_anti")
        marked = rows.withColumns({"source_id": F.lit(source), "batch_id": F.lit(batch_id).cast("bigint")})
        replace_partitions(marked, path, [day, *DELIVERY])

    return write


# The parts of the bronze table: as the stream wrote it, days handed over to a compaction, and compacted days.
LIVE, CLOSED, DAYS = "live", "closed", "days"
DAY, RUN = "event_date", "run"
DELIVERY = ("source_id", "batch_id")
BUCKETS = 16


def bronze_writer(
    path: str, partition_by: Sequence[str] = (DAY,), source_id: str | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that stamps a micro-batch and stores it by day, under its source and batch id.

    A batch replayed after a failure overwrites its own partitions, so every message is
    stored once. Batch ids start anew with every checkpoint; ``source_id`` keeps those of
    different streams apart. By default it is the query's id, which its checkpoint holds.
    ``partition_by`` is the day, with or without the symbol.
    """
    if DAY not in partition_by or set(partition_by) - {DAY, "symbol"}:
        raise ValueError(f"bronze is partitioned by {DAY}, with or without symbol")
    others = [c for c in partition_by if c != DAY]

    def write(batch: DataFrame, batch_id: int) -> None:
        source = source_id or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not source:
            raise ValueError("a batch outside a streaming query needs a source_id")
        stamped = batch.drop("timestamp").withColumns({
            "ingestion_time": F.current_timestamp(),
            "source_id": F.lit(source),
            "batch_id": F.lit(batch_id).cast("bigint"),
        })
        # the day comes first, so that all its batches are one folder that can be moved
        replace_partitions(stamped, f"{path}/{LIVE}", [DAY, *others, *DELIVERY])

    return write


def compacted_days(spark: SparkSession, path: str) -> VersionedTable:
    """The table of the days that were brought together."""
    return VersionedTable(spark, f"{path}/{DAYS}", DAY)


def _folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """The folders that match a pattern, as names below ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    depth = pattern.count("/") + 1
    return ["/".join(s.getPath().toString().split("/")[-depth:]) for s in found]


def _part(spark: SparkSession, path: str, part: str) -> tuple[DataFrame | None, set[str]]:
    """The rows that lie in a part, and the days whose folders it has."""
    folders = _folders(spark, path, f"{LIVE}/{DAY}=*" if part == LIVE else f"{CLOSED}/{RUN}=*/{DAY}=*")
    if not folders:
        return None, set()
    df = spark.read.parquet(f"{path}/{part}")
    kinds = {"source_id": "string", "batch_id": "bigint", DAY: "date", "symbol": "string", RUN: "string"}
    typed = df.withColumns({c: F.col(c).cast(t) for c, t in kinds.items() if c in df.columns})
    return typed, {f.rsplit("=", 1)[1] for f in folders}


# What a batch stores in one step: its rows of a day, or of a day and symbol.
STEP = (*DELIVERY, DAY, "symbol")


def _fresh(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows of deliveries that are not stored yet.

    Two parts hold the same delivery only after a batch was replayed or a compaction broke off before it had removed
    what it had stored.
    """
    seen = stored.select(*[F.col(c).alias(f"_of_{c}") for c in STEP]).distinct()
    return rows.join(seen, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in STEP], "left_anti")


def _once(closed: DataFrame) -> DataFrame:
    """Each delivery from the first run that holds it."""
    first = F.min(RUN).over(Window.partitionBy(*STEP))
    return closed.withColumn("_first", first).filter(F.col(RUN) == F.col("_first")).drop(RUN, "_first")


def read_bronze(spark: SparkSession, path: str) -> DataFrame | None:
    """The bronze ticks: the compacted days and what the stream has written since; None before the first.

    The parts are listed in the order in which rows pass through them, so a compaction at the same time hides nothing:
    a day it moves is found where it goes. A reader whose files it removes fails and can be run again.
    """
    live, live_days = _part(spark, path, LIVE)
    closed, closed_days = _part(spark, path, CLOSED)
    table = compacted_days(spark, path)
    version = table.version()
    parts = [] if version is None else [table.read(version.number)]

    def stored_on(days: set[str]) -> DataFrame | None:
        if version is None or not days & version.parts.keys():
            return None
        return table.read(version.number, lambda v: v in days)

    if closed is not None:
        closed, known = _once(closed), stored_on(closed_days)
        parts.append(closed if known is None else _fresh(closed, known))
    if live is not None:
        for known in (closed if live_days & closed_days else None, stored_on(live_days)):
            live = live if known is None else _fresh(live, known)
        parts.append(live)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def _close(spark: SparkSession, path: str, before: dt.date) -> None:
    """Hand the live days before ``before`` over to a compaction: one move a day, whatever number of batches it holds.

    A batch that is written at the same time stores its day in a new live folder, or fails and is replayed there.
    """
    run = f"{path}/{CLOSED}/{RUN}={uuid.uuid4().hex}"
    to = spark._jvm.org.apache.hadoop.fs.Path(run)
    files = to.getFileSystem(spark._jsc.hadoopConfiguration())
    days = [f for f in _folders(spark, path, f"{LIVE}/{DAY}=*") if _before(f.rsplit("=", 1)[1], before)]
    if days:
        files.mkdirs(to)
    for folder in days:
        source = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        if not files.rename(source, spark._jvm.org.apache.hadoop.fs.Path(f"{run}/{source.getName()}")):
            raise OSError(f"{source} could not be moved to {run}")


def _before(day: str, before: dt.date) -> bool:
    try:
        return dt.date.fromisoformat(day) < before
    except ValueError:  # rows without a day stay live
        return False


def compact_days(spark: SparkSession, path: str, before: dt.date, buckets: int = BUCKETS) -> None:
    """Bring the live rows of days before ``before`` together by day and symbol bucket.

    Each day's folder is moved out of the stream's way, then all days are stored in one commit, with what they held
    already, and what was moved is removed. The driver handles days, never single batches. If this breaks off anywhere,
    readers see every delivery once and the next run goes on with what was moved;
    of two at a time one fails with ``Conflict``. Old versions go with ``compacted_days(...).vacuum()``, apart from this.
    """
    _close(spark, path, before)
    moved = _folders(spark, path, f"{CLOSED}/{RUN}=*/{DAY}=*")
    closed, touched = _part(spark, path, CLOSED)
    if closed is None:
        return
    table = compacted_days(spark, path)
    base = table.version()
    rows = _once(closed)
    if base is not None and touched & base.parts.keys():
        stored = table.read(base.number, lambda v: v in touched)
        rows = _fresh(rows, stored).unionByName(stored, allowMissingColumns=True)
    bucket = F.pmod(F.hash("symbol"), F.lit(buckets))
    table.commit(rows, base=base, spread=bucket, order=["symbol", "event_time"])
    # exactly what was read: another run's folder may have gained a day since
    for folder in moved:
        remove(spark, f"{path}/{folder}")
    for run in sorted({f.rsplit("/", 1)[0] for f in moved}):
        if not _folders(spark, path, f"{run}/*"):
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{run}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, False)


def bronze_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = ("event_date",),
    interval: str | None = TRIGGER_INTERVAL,
    source_id: str | None = None,
) -> DataStreamWriter:
    """The tick pipeline, ready to ``start()``; without ``interval`` it stops at the end of the input."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        tick_stream(messages).writeStream.foreachBatch(bronze_writer(path, partition_by, source_id))
        .outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger)
    )
