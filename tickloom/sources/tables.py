"""Tables on shared storage: create, append, replace, publish. All writes can be repeated."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tickloom.operators.upsert import replace_window, within
from tickloom.sources.versions import VersionedTable, months_between, table_version


@dataclass(frozen=True)
class Published:
    """A table of the serving copy; ``date`` is NULL for one that is replaced whole."""

    name: str
    date: str | None = "date"


# The serving copy's tables.
PUBLISHED_TABLES = [
    Published("silver_symbols", None),
    Published("silver_ohlcv"),
    Published("gold_52w_levels"),
    Published("gold_anomaly_flags"),
    Published("gold_sector_performance"),
    Published("gold_volatility_index"),
    Published("gold_intraday_vwap", "session_date"),
    Published("gold_technical_rating"),
]


def create_table_if_absent(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """An empty partitioned Parquet table in the catalog, unless it is there already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}")


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows; columns new to the table are found by :func:`read_merged`."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files may have gained columns over time."""
    return spark.read.option("mergeSchema", True).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df``, leave the others alone.

    Rows are brought together by partition first, so that each partition is
    written as few files; ``REBALANCE`` lets Spark split a large one.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path)
    )


def bulk_load(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), truncate: bool = True
) -> None:
    """Load everything in one write: replace the table, or add to it."""
    writer = df.hint("rebalance", *partition_by) if partition_by else df
    mode = "overwrite" if truncate else "append"
    # a full replace must also drop partitions that no longer occur
    writer.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(
        *partition_by
    ).parquet(path)


def month_number(date: Column) -> Column:
    """The month of a date as a whole number, 199903: the partition of dated tables."""
    day = date.cast("date")
    return F.year(day) * 100 + F.month(day)


def by_month(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("month", month_number(F.col(date)))


def in_months(df: DataFrame, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """The partitions of the months from ``since`` to ``until``; others are not listed or opened."""
    if since:
        df = df.filter(F.col("month") >= since.year * 100 + since.month)
    if until:
        df = df.filter(F.col("month") <= until.year * 100 + until.month)
    return df


def publish_window(source: DataFrame, path: str, date: str, start: str, days: int) -> None:
    """Make the serving table's ``[start, start + days)`` equal to the source's.

    The table is partitioned by month. The months of the window are read, their rows of the window exchanged, and the
    months written again in one commit; a month that has become empty is dropped by it. Readers see the
    table before or after, and a repeated run ends in the same state.
    """
    serving = VersionedTable(source.sparkSession, path)
    first = dt.date.fromisoformat(start)
    last = first + dt.timedelta(days=days - 1)
    wanted = months_between(first, last)
    fresh = by_month(source.drop("month").filter(within(F.col(date), start, days)), date)
    base = serving.version()
    if base is not None:
        stored = serving.read(base.number, wanted)
        fresh = replace_window(stored, fresh, date, start, days)
    serving.commit(fresh, base=base, removed=[m for m in (base.parts if base else ()) if wanted(m)])


def load_version(df: DataFrame, path: str, date: str | None, notes: dict[str, str] | None = None) -> None:
    """Replace a table's whole content in one commit, by month of ``date`` or undivided."""
    rows = df if date is None else by_month(df, date)
    VersionedTable(df.sparkSession, path, "month" if date else None).commit(rows, whole=True, notes=notes)


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """A table's last version, without its partition column."""
    return table_version(spark, path).read().drop("month")


def remove(spark: SparkSession, path: str) -> None:
    gone = spark._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def publish_all(
    spark: SparkSession,
    source_dir: str,
    serving_dir: str,
    *,
    tables: Sequence[Published] = tuple(PUBLISHED_TABLES),
    only: Sequence[str] | None = None,
    truncate: bool = True,
) -> Mapping[str, int | None]:
    """Copy whole tables to the serving folder; returns row counts, None for an absent source."""
    counts: dict[str, int | None] = {}
    for table in tables:
        if only is not None and table.name not in only:
            continue
        source, target = f"{source_dir}/{table.name}", f"{serving_dir}/{table.name}"
        rows = read_any(spark, source)
        if rows is None:
            counts[table.name] = None
            continue
        seen = Observation()
        # counted while it is written
        counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        if not truncate and (served := table_version(spark, target)) is not None:
            counted = served.read().drop("month").unionByName(counted, allowMissingColumns=True)
        load_version(counted, target, table.date)
        counts[table.name] = seen.get["n"]
    return counts


def publish_windows(
    spark: SparkSession,
    source_dir: str,
    serving_dir: str,
    start: str,
    days: int = 7,
    tables: Sequence[Published] = tuple(PUBLISHED_TABLES),
) -> list[str]:
    """The window of every dated table, and the dimensions whole; returns what was skipped."""
    skipped = []
    for table in tables:
        df = read_any(spark, f"{source_dir}/{table.name}")
        if df is None:
            skipped.append(table.name)
            continue
        target = f"{serving_dir}/{table.name}"
        if table.date is None:
            load_version(df, target, None)
        else:
            publish_window(df, target, table.date, start, days)
    return skipped


def publish_jdbc(
    df: DataFrame, url: str, table: str, *, truncate: bool = True, **properties: str
) -> None:
    """Full copy into a database whose driver is on the class path.

    ``truncate`` keeps the existing table definition and replaces its rows.
    """
    mode = "overwrite" if truncate else "append"
    df.write.mode(mode).option("truncate", truncate).jdbc(url, table, properties=properties)


def read_any(spark: SparkSession, path: str) -> DataFrame | None:
    """A table's last version, or a plain folder of Parquet files; None where there is neither."""
    if table_version(spark, path) is not None:
        return read_version(spark, path)
    return spark.read.parquet(path).drop("month") if table_exists(spark, path) else None


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one with its declared schema."""
    found = read_any(spark, path)
    return spark.createDataFrame([], schema) if found is None else found
