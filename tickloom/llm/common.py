"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# The space and the controls from tab to carriage return: what separates words.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"
# Rows longer than this are worked on in several parts, batches of rows in several slices.
SLICE_BYTES = 4 << 20


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have, whatever its columns are called."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def col(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return df["`" + name.replace("`", "``") + "`"]


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    found = F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+")
    return F.filter(found, lambda w: w != "")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path in the shared folder, reachable from every task."""
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if path.startswith("s3a:") else path)


def below(key: Column, share: Column | float) -> Column:
    """Whether a 64-bit hash lies in the lowest ``share`` of all values: a sample that only the rows decide."""
    return key.cast("double") / 2.0**64 + 0.5 < share


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_arrow(
    df: DataFrame, column: str, added: list[str], make: Callable[[pa.Array], list[pa.Array]], most: int = SLICE_BYTES,
) -> DataFrame:
    """``df`` with the columns ``added`` (name and type), made from one column in slices of about ``most`` bytes.

    ``make`` gets a slice of the column, nulls included, and returns the new columns. Columns go by their
    place, so their names may be any.
    """
    at = df.columns.index(column)
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(", ".join(added)).fields])
    names = [f"c{k}" for k in range(len(schema))]  # whatever the columns are called, dots and repeats included

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at, most):
            yield pa.RecordBatch.from_arrays([*batch.columns, *make(batch.column(at))], names=names)

    told = df.toDF(*names[: len(df.columns)]).mapInArrow(run, T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(names, schema)]))
    return told.toDF(*schema.names)


def slices(batches: Iterable[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose text column holds about ``most`` bytes; a longer text is alone."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        marks = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = marks[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(marks, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to
