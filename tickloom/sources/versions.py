"""Tables whose states follow each other by a log of commits.

    <table>/data/<partition>=<value>/commit=<id>/   files of one commit, written once and never changed
    <table>/log/0000000012.json                     which commit holds each partition in version 12

A commit writes its files under an id of its own, then one manifest that names the folders of the new state. Moving
the manifest to its number is the switch: before it readers see the old state whole, after it the new one. What a job
that broke off has written is named by no manifest, so nobody reads it, and ``vacuum`` removes it. Two jobs
that commit on the same version move to the same number; the second finds it taken and fails with :class:`Conflict`.

The switch is a rename that fails where the target exists, so the folder has to be on a file system with
atomic renames (a local or mounted one, HDFS).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

COMMIT = "commit"


class Conflict(RuntimeError):
    """Another commit was made on the version that this one started from."""


@dataclass(frozen=True)
class Version:
    """One state of a table: the commit that holds each partition, and what jobs have noted."""

    number: int
    parts: dict[str, str]
    schema: T.StructType
    notes: dict[str, str] = field(default_factory=dict)


LAST = object()  # whatever version is the last when a commit begins


@dataclass(frozen=True)
class VersionedTable:
    """A table under ``path``, in partitions by one column (None: a single one)."""

    spark: SparkSession
    path: str
    partition: str | None = "month"

    # --- the log

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def numbers(self) -> list[int]:
        """The numbers of the versions that are kept, ascending."""
        log = self._path("log")
        if not self._files().exists(log):
            return []
        names = [s.getPath().getName() for s in self._files().listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def exists(self) -> bool:
        return bool(self.numbers())

    def version(self, number: int | None = None) -> Version | None:
        """A version, by default the last; None for a table without any."""
        if number is None:
            found = self.numbers()
            if not found:
                return None
            number = found[-1]
        stream = self._files().open(self._path(f"log/{number:010d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        told = json.loads(text)
        return Version(number, told["parts"], T.StructType.fromJson(told["schema"]), told["notes"])

    def _switch(self, version: Version) -> None:
        """Make a version the last one, unless its number is taken."""
        files, hidden = self._files(), self._path(f"log/.{uuid.uuid4().hex}")
        told = {"parts": version.parts, "schema": version.schema.jsonValue(), "notes": version.notes}
        out = files.create(hidden, False)
        try:
            out.write(bytearray(json.dumps(told).encode()))
        finally:
            out.close()
        target = self._path(f"log/{version.number:010d}.json")
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            target.toUri() if target.toUri().getScheme() else files.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(hidden, target, options)
        except Exception as e:
            files.delete(hidden, False)
            if files.exists(target):
                raise Conflict(f"{self.path}: version {version.number} was committed by another job") from e
            raise

    # --- reading

    def folder(self, value: str, commit: str) -> str:
        part = f"{self.partition}={value}/" if self.partition else ""
        return f"{self.path}/data/{part}{COMMIT}={commit}"

    def read(
        self, number: int | None = None, wanted: Callable[[str], bool] | None = None
    ) -> DataFrame:
        """A version's rows, by default the last one's; ``wanted`` tells the partitions whose folders are opened.

        The files of a version don't change, so a frame that was read before a commit goes on reading its own state.
        """
        version = self.version(number)
        if version is None:
            raise FileNotFoundError(f"no version of {self.path}")
        folders = [self.folder(v, c) for v, c in version.parts.items() if wanted is None or wanted(v)]
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        # without inference: the manifest knows the columns, and files that lack one give NULL
        stored = T.StructType([*version.schema.fields, T.StructField(COMMIT, T.StringType())])
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*folders)
        return rows.drop(COMMIT).select(*version.schema.names)

    # --- committing

    def commit(
        self, rows: DataFrame, *, base: Version | None = LAST, whole: bool = False, removed: Sequence[str] = (),
        notes: dict[str, str] | None = None, spread: Column | None = None, order: Sequence[str] = (),
    ) -> Version:
        """Replace the partitions that occur in ``rows``, and drop those ``removed``, in one step.

        ``whole`` replaces all partitions. ``base`` is the version that ``rows`` were made from, None if the table had
        none, by default the last; if there is a later one by now, nothing changes and :class:`Conflict` is raised. Columns that only one side has
        are kept, NULL in the other. Rows are brought together by partition, and within it by ``spread``, and a large one is
        split (``REBALANCE``). ``order`` sorts the rows of a file.
        """
        base = self.version() if base is LAST else base
        commit = uuid.uuid4().hex
        marked = rows.withColumn(COMMIT, F.lit(commit))
        keys = [self.partition] if self.partition else []
        if spread is not None:  # the hint takes names only
            arranged = marked.withColumn("_spread", spread).hint("rebalance", *keys, "_spread").drop("_spread")
        else:
            arranged = marked.hint("rebalance", *keys) if keys else marked
        (
            (arranged.sortWithinPartitions(*keys, *order) if order else arranged)
            .write.mode("append").partitionBy(*keys, COMMIT).parquet(f"{self.path}/data")
        )
        old = {} if base is None or whole else {k: c for k, c in base.parts.items() if k not in set(removed)}
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
        if base is not None and not whole:
            names = set(schema.names)
            schema = T.StructType([*schema.fields, *[f for f in base.schema.fields if f.name not in names]])
        version = Version(
            (base.number if base else 0) + 1, old | dict.fromkeys(self._filled(commit), commit), schema,
            ({} if base is None else base.notes) | (notes or {}))
        self._switch(version)
        return version

    def _filled(self, commit: str) -> list[str]:
        """The partitions a commit has written files to."""
        pattern = self.folder("*", commit) if self.partition else self.folder("", commit)
        found = self._files().globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(pattern)) or []
        if not self.partition:
            return [""] if len(found) else []
        return [s.getPath().getParent().getName().split("=", 1)[1] for s in found]

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the last ``keep`` versions, and files that none of them names.

        Not to be run beside a commit, whose files no version names yet, nor while older versions are read.
        """
        files, numbers = self._files(), self.numbers()
        for number in numbers[:-keep]:
            files.delete(self._path(f"log/{number:010d}.json"), False)
        named = {self.folder(v, c) for n in numbers[-keep:] for v, c in self.version(n).parts.items()}
        pattern = self._path(f"data/{self.partition}=*/{COMMIT}=*" if self.partition else f"data/{COMMIT}=*")
        for status in files.globStatus(pattern) or []:
            at = status.getPath()
            value = at.getParent().getName().split("=", 1)[1] if self.partition else ""
            if self.folder(value, at.getName().split("=", 1)[1]) not in named:
                files.delete(at, True)


def table_version(spark: SparkSession, path: str) -> VersionedTable | None:
    """The table under a path as its log shows it, whatever it is partitioned by; None where there is none."""
    table = VersionedTable(spark, path, None)
    version = table.version()
    if version is None:
        return None
    dated = any(version.parts)
    return VersionedTable(spark, path, "month") if dated else table


def months_between(since: dt.date | None, until: dt.date | None) -> Callable[[str], bool]:
    """Which partitions by month hold days from ``since`` to ``until``."""
    low = since.year * 100 + since.month if since else None
    high = until.year * 100 + until.month if until else None

    def wanted(value: str) -> bool:
        if not value.isdigit():  # rows without a date
            return low is None and high is None
        return (low is None or int(value) >= low) and (high is None or int(value) <= high)

    return wanted
