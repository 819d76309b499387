"""Written intermediate tables, and the package's code on the executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from contrail.session import scratch_path

_SHIPPED: set[str] = set()


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_buckets(df: DataFrame, label: str, count: int, column: str) -> DataFrame:
    """``store`` by ``count`` buckets of ``column``: joins and aggregates by it leave the rows where they are."""
    spark, name = df.sparkSession, f"contrail_{label}_{uuid.uuid4().hex}"
    df.write.bucketBy(count, column).option("path", scratch_path(spark, label)).saveAsTable(name, format="parquet")
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the name: the files are not the catalog's
    return out


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="contrail-")) / "contrail-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
