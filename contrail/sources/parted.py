"""Stored state in partitions, of which a batch rewrites only those it touches.

The partition of a row is a column that follows from its key: a hash bucket for
one-row-per-key state, a day for time buckets. A change reads the touched
partitions (the scan is pruned to them), computes their new rows and replaces
them by dynamic partition overwrite; the others are neither read nor written.
Every row names the last batch that changed its partition, so that a batch run
again after a failure can leave out partitions that have it already.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.sources.tables import Lake

PART, BATCH = "_part", "_batch"


def hash_bucket(n: int, *keys: str) -> Column:
    """One of ``n`` buckets; equal keys share one."""
    return F.pmod(F.hash(*keys), F.lit(n)).cast("string")


def day_of(time: str) -> Column:
    """The day of a time; rows without one have a partition of their own."""
    return F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit("none"))


class PartedTable:
    """One table below ``path``. ``part`` must give the same partition for a row whenever it is asked.

    Without another count in the path, a changed number of buckets would split
    keys over two partitions; :func:`bucketed` puts it there.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, part: Column):
        self.spark, self.path, self.schema, self.part = spark, path.rstrip("/"), schema, part
        extra = [T.StructField(BATCH, T.LongType()), T.StructField(PART, T.StringType())]
        self._stored = T.StructType([*schema.fields, *extra])

    def _all(self) -> DataFrame:
        if not Lake(self.spark, self.path).exists(self.path):
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).option("basePath", self.path).parquet(self.path)

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """The rows, of the named partitions only if any are named."""
        rows = self._all()
        if parts is not None:
            rows = rows.filter(F.col(PART).isin(parts) if parts else F.lit(False))
        return rows.select(*self.schema.names)

    def touched(self, *rows: DataFrame) -> list[str]:
        """The partitions of the given rows: at most as many names as the table has partitions."""
        found = rows[0].select(self.part.alias(PART))
        for more in rows[1:]:
            found = found.unionByName(more.select(self.part.alias(PART)))
        return sorted(r[0] for r in found.distinct().collect())

    def pending(self, parts: list[str], batch: int) -> list[str]:
        """Those of the partitions that do not have the batch yet."""
        done = self._all().filter(F.col(PART).isin(parts) & (F.col(BATCH) >= batch)) if parts else None
        taken = {r[0] for r in done.select(PART).distinct().collect()} if parts else set()
        return [p for p in parts if p not in taken]

    def change(
        self,
        rows: DataFrame,
        merge: Callable[[DataFrame, DataFrame], DataFrame],
        batch: int,
        once: bool = False,
        parts: list[str] | None = None,
    ) -> list[str]:
        """Replace the partitions of ``rows`` by ``merge(known, rows)``; gives their names.

        ``once`` leaves out partitions that have the batch already; merges that
        can be repeated, such as an upsert, do not need it. ``parts`` names the
        partitions of the rows where they are known.
        """
        parts = self.touched(rows) if parts is None else parts
        if once:
            parts = self.pending(parts, batch)
            rows = rows.filter(self.part.isin(parts)) if parts else rows
        if parts:
            self.replace(merge(self.read(parts), rows), batch)
        return parts

    def replace(self, rows: DataFrame, batch: int) -> None:
        """Write whole partitions; what is not named in ``rows`` stays. Large partitions get several files."""
        stamped = rows.select(*self.schema.names, F.lit(batch).cast("bigint").alias(BATCH), self.part.alias(PART))
        even = stamped.hint("rebalance", PART)
        even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path)


def bucketed(spark: SparkSession, root: str, schema: T.StructType, n: int, *keys: str) -> PartedTable:
    """A table in ``n`` hash buckets of its keys."""
    return PartedTable(spark, f"{root.rstrip('/')}/of={n}", schema, hash_bucket(n, *keys))


def by_day(spark: SparkSession, root: str, schema: T.StructType, time: str) -> PartedTable:
    return PartedTable(spark, root, schema, day_of(time))
