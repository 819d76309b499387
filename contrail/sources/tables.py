"""Stored tables on plain parquet folders.

Logs (raw, clean, change events, closed history) get one ``batch_id=n`` folder
per batch; writing a batch again replaces its folder, so a replay is harmless.
State (current, open history) gets one ``version=n`` folder per version that
writes it, and an empty marker file below ``_manifest`` afterwards. A commit need
not write every table: a table's state at a version is the newest committed one
up to it. A batch counts only once its commit row is written, which happens last.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schemas
from contrail.functions.time import instant

NO_VERSION = -1


class Lake:
    """The tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _hadoop(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def exists(self, path: str) -> bool:
        fs, where = self._hadoop(path)
        return fs.exists(where)

    def empty(self, schema: T.StructType) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    # ---- logs ---------------------------------------------------------------
    def write_log(self, table: str, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path(table)}/batch_id={batch_id}")

    def read_log(self, table: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
        """Rows of all batches up to ``upto`` (default: the last commit)."""
        last = self.last_commit() if upto is None else upto
        with_batch = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
        if not self.exists(self.path(table)):
            return self.empty(with_batch)
        return (
            self.spark.read.schema(with_batch)
            .option("basePath", self.path(table))
            .parquet(self.path(table))
            .filter(F.col("batch_id") <= last)
        )

    def read_batch(self, table: str, schema: T.StructType, batch_id: int) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path(table)}/batch_id={batch_id}")

    def read_batches(self, table: str, schema: T.StructType, after: int, upto: int) -> DataFrame:
        """Rows of the batches after ``after`` up to ``upto``."""
        return self.read_log(table, schema, upto).filter(F.col("batch_id") > after).drop("batch_id")

    # ---- state --------------------------------------------------------------
    def mark(self, table: str, version: int) -> None:
        fs, where = self._hadoop(f"{self.path('_manifest')}/{table}/{version}")
        fs.create(where, True).close()

    def versions(self, table: str) -> list[int]:
        """The versions that wrote a table, committed or not; one short name each."""
        fs, where = self._hadoop(f"{self.path('_manifest')}/{table}")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(where)) if fs.exists(where) else []

    def latest(self, table: str, upto: int | None = None) -> int:
        """The newest committed version, up to ``upto``, that wrote this table."""
        committed = set(self.versions("commits"))
        # The version being written reads its own state before its commit.
        done = [v for v in self.versions(table) if (upto is None or v <= upto) and (v in committed or v == upto)]
        return max(done, default=NO_VERSION)

    def write_state(self, table: str, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path(table)}/version={version}")
        self.mark(table, version)

    def read_state(
        self, table: str, schema: T.StructType, version: int | None = None
    ) -> DataFrame:
        """State as of a version; empty only if no version up to it wrote the table."""
        found = self.latest(table, version)
        where = f"{self.path(table)}/version={found}"
        if found == NO_VERSION:
            return self.empty(schema)
        if not self.exists(where):
            raise FileNotFoundError(f"{where} was written by version {found} and is gone")
        return self.spark.read.schema(schema).parquet(where)

    # ---- commits ------------------------------------------------------------
    def commit(
        self,
        version: int,
        operation: str,
        metrics: DataFrame,
        as_of: datetime | None = None,
        source: str | None = None,
    ) -> None:
        """Publish a version. ``metrics`` is one row, kept as JSON text.

        ``source`` names what the version was made from, so that a repeated
        delivery can be recognised.
        """
        row = metrics.select(
            F.lit(version).cast("bigint").alias("version"),
            instant(as_of).alias("committed_at"),
            F.lit(operation).alias("operation"),
            F.to_json(F.struct("*")).alias("operation_metrics"),
            F.lit(source).cast("string").alias("source"),
        )
        self.write_log("commits", row.coalesce(1), version)
        self.mark("commits", version)

    def commits(self) -> DataFrame:
        if not self.exists(self.path("commits")):
            return self.empty(schemas.COMMITS)
        return self.spark.read.schema(schemas.COMMITS).parquet(self.path("commits"))

    def last_commit(self, before: int | None = None) -> int:
        return max((v for v in self.versions("commits") if before is None or v < before), default=NO_VERSION)

    def has_taken(self, source: str) -> bool:
        return not self.commits().filter(F.col("source") == source).isEmpty()

    # ---- layers -------------------------------------------------------------
    def clear(self, tables: list[str], confirm: bool = False) -> list[str]:
        """Delete the named tables; does nothing unless confirmed."""
        gone = []
        for table in tables if confirm else []:
            fs, where = self._hadoop(self.path(table))
            if fs.delete(where, True):
                gone.append(table)
            fs, marks = self._hadoop(f"{self.path('_manifest')}/{table}")
            fs.delete(marks, True)
        return gone

    def compact(self, table: str, schema: T.StructType, batch_id: int, target: str) -> None:
        """Rewrite one batch into another table in evenly sized files."""
        even = self.read_batch(table, schema, batch_id).hint("rebalance")
        even.write.mode("overwrite").parquet(f"{self.path(target)}/batch_id={batch_id}")


def commit_history(commits: DataFrame, limit: int = 5) -> DataFrame:
    """The newest commits."""
    return commits.orderBy(F.desc("version")).limit(limit)


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every given table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def sample_table(df: DataFrame, limit: int = 20) -> DataFrame:
    return df.limit(limit)


# ---- catalog tables ----------------------------------------------------------
# Table names.
CATALOG_TABLES = {
    "flight_raw": schemas.RAW_N,
    "flight_clean": schemas.CLEAN_N,
    "flight_current": schemas.CURRENT_N,
    "flight_history": schemas.HISTORY_N,
    "flight_cdc": schemas.CDC_N,
    "flight_metrics": schemas.METRICS_N,
    "bronze_audit": schemas.AUDIT,
    "adsb_raw": schemas.LANDING,
}


def ensure_tables(
    spark: SparkSession, database: str, tables: dict[str, T.StructType] | None = None
) -> None:
    """Create the namespace and its parquet tables where they are missing."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
    for name, schema in (tables or CATALOG_TABLES).items():
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({fields}) USING parquet")


def append_table(df: DataFrame, table: str) -> None:
    df.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def overwrite_table(df: DataFrame, table: str) -> None:
    df.select(*df.sparkSession.table(table).columns).write.mode("overwrite").insertInto(table)


def list_layer(spark: SparkSession, database: str, pattern: str = "*") -> list[str]:
    return [t.name for t in spark.catalog.listTables(database, pattern) if not t.isTemporary]


def layer_profile(spark: SparkSession, database: str, pattern: str = "*") -> DataFrame:
    """Row counts of the catalog tables of one namespace."""
    names = list_layer(spark, database, pattern)
    if not names:
        return spark.createDataFrame([], "table_name STRING, row_count BIGINT")
    return table_profile({name: spark.table(f"{database}.{name}") for name in names})


def drop_layer(
    spark: SparkSession, database: str, pattern: str = "*", confirm: bool = False
) -> list[str]:
    """Drop the namespace's tables; does nothing unless confirmed."""
    names = list_layer(spark, database, pattern) if confirm else []
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    return names


def truncate_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")
