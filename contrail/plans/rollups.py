"""The profile L marts kept up to date batch by batch.

Same results as :mod:`contrail.plans.marts` on the whole clean log, at the cost
of the batch plus the mart. Counts, sums and extremes are merged; buckets with
distinct counts are computed again, but only those the batch touches.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import schemas
from contrail.functions.time import instant, minus_minutes
from contrail.operators.keyed import lookup
from contrail.plans.marts import ACTIVE_MINUTES

AIRCRAFT = schemas.struct(
    "hex STRING, registration STRING, aircraft_type STRING, category STRING, "
    "first_seen TIMESTAMP, last_seen TIMESTAMP, total_observations BIGINT"
)
OPERATORS = schemas.struct(
    "operator STRING, flight_count BIGINT, altitude_sum DOUBLE, altitude_n BIGINT, "
    "speed_sum DOUBLE, speed_n BIGINT, last_seen TIMESTAMP"
)
TYPES = schemas.struct("region STRING, aircraft_type STRING, n BIGINT")


def aircraft_parts(clean: DataFrame) -> DataFrame:
    return clean.select(
        "hex", "registration", "aircraft_type", "category",
        F.col("ingested_at").alias("first_seen"), F.col("ingested_at").alias("last_seen"),
        F.lit(1).cast("bigint").alias("total_observations"),
    )


def merge_aircraft(known: DataFrame, batch: DataFrame) -> DataFrame:
    """Known totals per key plus a batch of clean rows."""
    both = known.select(*AIRCRAFT.names).unionByName(aircraft_parts(batch))
    return both.groupBy("hex").agg(
        F.max("registration").alias("registration"),
        F.max("aircraft_type").alias("aircraft_type"),
        F.max("category").alias("category"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("total_observations").alias("total_observations"),
    )


def aircraft_dim(totals: DataFrame, as_of: datetime | None = None) -> DataFrame:
    now = instant(as_of)
    return totals.select(
        "*",
        (F.col("last_seen") > minus_minutes(now, ACTIVE_MINUTES)).alias("is_active"),
        now.alias("updated_at"),
    )


def merge_operators(known: DataFrame, batch: DataFrame) -> DataFrame:
    """Known totals per callsign prefix plus a batch of clean rows."""
    parts = batch.filter(F.length("flight") >= 3).select(
        F.substring("flight", 1, 3).alias("operator"),
        F.lit(1).cast("bigint").alias("flight_count"),
        F.col("altitude_ft").alias("altitude_sum"),
        F.col("altitude_ft").isNotNull().cast("bigint").alias("altitude_n"),
        F.col("gs_knots").alias("speed_sum"),
        F.col("gs_knots").isNotNull().cast("bigint").alias("speed_n"),
        F.col("ingested_at").alias("last_seen"),
    )
    totals = [n for n in OPERATORS.names if n not in ("operator", "last_seen")]
    return (
        known.unionByName(parts)
        .groupBy("operator")
        .agg(*[F.sum(n).alias(n) for n in totals], F.max("last_seen").alias("last_seen"))
        .select(*OPERATORS.names)
    )


def _operator_averages() -> list[Column]:
    return [
        F.try_divide("altitude_sum", "altitude_n").alias("avg_altitude_ft"),
        F.try_divide("speed_sum", "speed_n").alias("avg_speed_knots"),
    ]


def airline_dim(totals: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return totals.select(
        F.col("operator").alias("callsign_prefix"), F.col("operator").alias("airline_name"),
        "flight_count", *_operator_averages(), "last_seen", instant(as_of).alias("updated_at"),
    )


def merge_types(known: DataFrame, batch: DataFrame) -> DataFrame:
    """Known counts per (region, type) plus a batch of clean rows."""
    typed = batch.filter("region IS NOT NULL AND aircraft_type IS NOT NULL")
    parts = typed.select("region", "aircraft_type", F.lit(1).cast("bigint").alias("n"))
    return known.unionByName(parts).groupBy("region", "aircraft_type").agg(F.sum("n").alias("n"))


def refresh_buckets(
    known: DataFrame, clean: DataFrame, batch: DataFrame, unit: str, time: str, build
) -> DataFrame:
    """A bucketed mart after a batch: touched buckets anew, the others kept.

    ``build`` makes the mart from clean rows; ``clean`` is the whole log with
    the batch in it. The oldest touched bucket bounds the scan of the log. Rows
    without a time have a bucket of their own, which a batch may touch like any.
    """
    bucket = F.date_trunc(unit, "ingested_at")
    never = F.lit("0001-01-01 00:00:00").cast("timestamp")  # stands for NULL in the joins
    touched = batch.select(F.coalesce(bucket, never).alias("_bucket")).distinct()
    oldest = batch.agg(F.date_trunc(unit, F.min("ingested_at")).alias("oldest")).scalar()
    recent = clean.filter((F.col("ingested_at") >= oldest) | F.col("ingested_at").isNull())
    recent = recent.withColumn("_bucket", F.coalesce(bucket, never))
    anew = build(lookup(recent, touched, ["_bucket"], "left_semi").drop("_bucket"))
    kept = known.withColumn("_bucket", F.coalesce(time, never)).join(touched, "_bucket", "left_anti")
    return kept.drop("_bucket").unionByName(anew)
