"""Data-quality and verification queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.time import is_corrupt_time
from contrail.operators.clean import live


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def region_profile(raw: DataFrame) -> DataFrame:
    """Rows, distinct keys and time range per region."""
    return raw.groupBy("source_region").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("hex").alias("aircraft"),
        F.min("fetched_at").alias("earliest"),
        F.max("fetched_at").alias("latest"),
    )


def null_profile(
    raw: DataFrame, columns: Sequence[str] = ("hex", "lat", "lon", "alt_baro")
) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )


def newest_rows(raw: DataFrame, limit: int = 10) -> DataFrame:
    return (
        raw.orderBy(F.desc("fetched_at"), "ingestion_id")
        .limit(limit)
        .select(
            "ingestion_id", "fetched_at", "source_region", "hex", "flight", "lat", "lon",
            "alt_baro", "gs", "registration", "aircraft_type", "category",
        )
    )


def time_range(df: DataFrame, time: str = "fetched_at") -> DataFrame:
    return df.agg(F.min(time).alias("earliest"), F.max(time).alias("latest"))


def deletion_counts(clean: DataFrame) -> DataFrame:
    deleted = F.col("is_deleted")
    return clean.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~deleted).alias("active"),
        F.count_if(deleted).alias("soft_deleted"),
    )


def reason_counts(clean: DataFrame) -> DataFrame:
    reason = F.coalesce("deleted_reason", F.lit("ACTIVE")).alias("reason")
    return clean.groupBy(reason).agg(F.count(F.lit(1)).alias("count"))


def state_by_region(current: DataFrame) -> DataFrame:
    deleted = F.col("is_deleted")
    return current.groupBy("source_region").agg(
        F.count_if(~deleted).alias("active"),
        F.count_if(deleted).alias("disappeared"),
        F.count_if(F.col("is_emergency")).alias("emergencies"),
    )


def versions_by_state(history: DataFrame) -> DataFrame:
    return history.groupBy("is_current").agg(F.count(F.lit(1)).alias("count"))


def newest_active(current: DataFrame, limit: int = 10) -> DataFrame:
    return (
        live(current)
        .select("hex", "callsign", "lat", "lon", "alt_baro", "gs", "source_region", "last_seen_at")
        .orderBy(F.desc("last_seen_at"), "hex")
        .limit(limit)
    )


def latest_scalars(metrics: DataFrame) -> DataFrame:
    """Scalar KPIs of the newest snapshot."""
    newest = metrics.agg(F.max("snapshot_at").alias("newest")).scalar()
    rows = metrics.filter(F.col("dimension").isNull() & (F.col("snapshot_at") == newest))
    return rows.select("metric_name", "metric_value").orderBy("metric_name")


def busiest_routes(routes: DataFrame, limit: int = 10) -> DataFrame:
    return (
        routes.orderBy(F.desc("total_observations"), "callsign", "airline_icao", "aircraft_type")
        .limit(limit)
        .select(
            "callsign", "airline_icao", "aircraft_type", "total_observations", "avg_altitude",
            "avg_speed", "regions_seen",
        )
    )


def busiest_cells(cells: DataFrame, limit: int = 10) -> DataFrame:
    return (
        cells.orderBy(F.desc("flight_count"), "lat_bucket", "lon_bucket")
        .limit(limit)
        .select(
            "grid_cell", "lat_bucket", "lon_bucket", "flight_count", "avg_altitude",
            "emergency_count", "military_count",
        )
    )


def snapshot_history(metrics: DataFrame, limit: int = 10) -> DataFrame:
    """Distinct metrics per snapshot minute, newest first."""
    return (
        metrics.groupBy(F.date_trunc("minute", "snapshot_at").alias("snapshot_min"))
        .agg(F.count_distinct("metric_name").alias("metrics"))
        .orderBy(F.desc("snapshot_min"))
        .limit(limit)
    )


def corrupt_times(raw: DataFrame, limit: int = 20) -> DataFrame:
    """Sample of rows with an implausible time."""
    return raw.filter(is_corrupt_time(F.col("fetched_at"))).limit(limit)


def missing_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per required column; all zero when the expectation holds."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; the job fails on the first NULL in a required column."""
    out = df
    for name in columns:
        message = F.lit(f"required column {name} is NULL")
        out = out.withColumn(
            name, F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name))
        )
    return out
