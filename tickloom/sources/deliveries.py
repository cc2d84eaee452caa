"""What arrived, delivery by delivery: the change log of a bronze table.

Each delivery is a partition, numbered in the order of commits. Who has taken in all up to a number opens only the
folders of later ones, however old the rows in them are. The number is noted in the commit of the table that took
them in, so rows and mark become visible together: a job that breaks off takes the same deliveries again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.sources.versions import VersionedTable

DELIVERED = "delivered"


@dataclass(frozen=True)
class Deliveries:
    spark: SparkSession
    path: str

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, self.path, DELIVERED)

    def last(self) -> int:
        """The number of the last delivery, 0 before the first."""
        version = self.table.version()
        return int(version.notes.get(DELIVERED, 0)) if version else 0

    def add(self, rows: DataFrame) -> int:
        """Store rows as the next delivery and return its number.

        Of two that are added at once one fails with ``Conflict`` and can be added again. A delivery that is added twice
        after a failure does no harm where rows are taken in by key.
        """
        base = self.table.version()
        number = self.last() + 1
        self.table.commit(rows.withColumn(DELIVERED, F.lit(number)), base=base, notes={DELIVERED: str(number)})
        return number

    def after(self, mark: int) -> tuple[DataFrame | None, int]:
        """The rows of the deliveries after a mark and the number of the last one; None if there are none."""
        version = self.table.version()
        last = self.last()
        if version is None or last <= mark:
            return None, mark
        rows = self.table.read(version.number, lambda v: int(v) > mark)
        return rows.filter(F.col(DELIVERED) > mark).drop(DELIVERED), last

    def forget(self, upto: int) -> None:
        """Drop deliveries that all readers have taken in; their files go with the next ``vacuum``."""
        version = self.table.version()
        gone = [v for v in version.parts if int(v) <= upto] if version else []
        if gone:
            none = self.spark.createDataFrame([], version.schema)
            self.table.commit(none, base=version, removed=gone)
