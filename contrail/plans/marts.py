"""Dimensions, time series and summaries (profile L)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from contrail.functions.time import instant, minus_minutes
from contrail.operators.keyed import latest_per_key
from contrail.plans.kpis import unpivot_row

ACTIVE_MINUTES = 5
TOP_OPERATORS = 20

# KPI names with their labels.
KPI_LABELS = {
    "active_flights": "Active Flights",
    "avg_altitude_ft": "Avg Altitude (ft)",
    "avg_speed_knots": "Avg Speed (knots)",
    "emergency_count": "Emergency Squawks",
    "unique_types": "Aircraft Types",
    "unique_airlines": "Airlines",
    "on_ground": "On Ground",
    "airborne": "Airborne",
}


def _prefix() -> Column:
    return F.substring("flight", 1, 3)


def _averages() -> list[Column]:
    return [F.avg("altitude_ft").alias("avg_altitude_ft"), F.avg("gs_knots").alias("avg_speed_knots")]


def aircraft_dim(clean: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One row per key: attributes, first and last seen, and whether it is active."""
    now = instant(as_of)
    return clean.filter(F.col("hex").isNotNull()).groupBy("hex").agg(
        F.max("registration").alias("registration"),
        F.max("aircraft_type").alias("aircraft_type"),
        F.max("category").alias("category"),
        F.min("ingested_at").alias("first_seen"),
        F.max("ingested_at").alias("last_seen"),
        F.count(F.lit(1)).alias("total_observations"),
        (F.max("ingested_at") > minus_minutes(now, ACTIVE_MINUTES)).alias("is_active"),
        now.alias("updated_at"),
    )


def _per_operator(clean: DataFrame) -> DataFrame:
    return clean.filter(F.length("flight") >= 3).groupBy(_prefix().alias("operator"))


def airline_dim(clean: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One row per callsign prefix; the name repeats the prefix."""
    return (
        _per_operator(clean)
        .agg(
            F.count(F.lit(1)).alias("flight_count"),
            *_averages(),
            F.max("ingested_at").alias("last_seen"),
        )
        .select(
            F.col("operator").alias("callsign_prefix"),
            F.col("operator").alias("airline_name"),
            "flight_count", "avg_altitude_ft", "avg_speed_knots", "last_seen",
            instant(as_of).alias("updated_at"),
        )
    )


def minute_metrics(clean: DataFrame) -> DataFrame:
    """Counts, averages and peaks per (minute, region)."""
    return clean.groupBy(F.date_trunc("minute", "ingested_at").alias("metric_time"), "region").agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count_if(F.col("on_ground")).alias("on_ground"),
        F.count_if(~F.col("on_ground")).alias("airborne"),
        F.avg("altitude_ft").alias("avg_altitude_ft"),
        F.max("altitude_ft").alias("max_altitude_ft"),
        F.avg("gs_knots").alias("avg_speed_knots"),
        F.max("gs_knots").alias("max_speed_knots"),
        F.count_if(F.col("is_emergency")).alias("emergency_count"),
        F.count_distinct("hex").alias("unique_aircraft"),
        F.count_distinct(_prefix()).alias("unique_airlines"),
    )


def kpis(current: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Eight KPIs as (name, value, label, time) rows."""
    emergency_key = F.when(F.col("is_emergency"), F.col("hex"))
    wide = current.agg(
        F.count_distinct("hex").alias("active_flights"),
        F.round(F.avg("altitude_ft"), 0).alias("avg_altitude_ft"),
        F.round(F.avg("gs_knots"), 0).alias("avg_speed_knots"),
        F.count_distinct(emergency_key).alias("emergency_count"),
        F.count_distinct("aircraft_type").alias("unique_types"),
        F.count_distinct(_prefix()).alias("unique_airlines"),
        F.sum(F.when(F.col("on_ground"), 1).otherwise(0)).alias("on_ground"),
        F.sum(F.when(~F.col("on_ground"), 1).otherwise(0)).alias("airborne"),
    )
    label = F.create_map(*[F.lit(x) for pair in KPI_LABELS.items() for x in pair])
    return unpivot_row(wide, "kpi_name", "kpi_value").select(
        "kpi_name", "kpi_value", label[F.col("kpi_name")].alias("kpi_label"),
        instant(as_of).alias("computed_at"),
    )


def type_counts(clean: DataFrame) -> DataFrame:
    """Clean rows per (region, type)."""
    typed = clean.filter("region IS NOT NULL AND aircraft_type IS NOT NULL")
    return typed.groupBy("region", "aircraft_type").agg(F.count(F.lit(1)).alias("n"))


def region_summary(
    current: DataFrame, clean: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """Per region: state counts and averages, and the commonest type in the clean log."""
    return region_summary_of(current, type_counts(clean), as_of)


def region_summary_of(
    current: DataFrame, counts: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """The region summary from type counts kept elsewhere."""
    commonest = latest_per_key(counts, ["region"], [F.desc("n"), F.col("aircraft_type")])
    totals = current.groupBy("region", "region_label").agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count(F.lit(1)).alias("active_now"),
        *_averages(),
        F.count_if(F.col("is_emergency")).alias("emergency_count"),
    )
    top = commonest.select("region", F.col("aircraft_type").alias("top_aircraft_type"))
    return totals.join(top, "region", "left").withColumn("computed_at", instant(as_of))


def top_operators(
    clean: DataFrame, k: int = TOP_OPERATORS, as_of: datetime | None = None
) -> DataFrame:
    """The k commonest prefixes with their rank; ties go by prefix."""
    totals = _per_operator(clean).agg(F.count(F.lit(1)).alias("flight_count"), *_averages())
    return rank_operators(totals, k, as_of)


def rank_operators(
    totals: DataFrame, k: int = TOP_OPERATORS, as_of: datetime | None = None
) -> DataFrame:
    """Rank the k largest totals. The window sees only the k surviving rows."""
    order = [F.desc("flight_count"), F.col("operator")]
    ranked = (
        totals.orderBy(*order)
        .limit(k)
        .withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    )
    return ranked.select(
        "rank", "operator", "flight_count", "avg_altitude_ft", "avg_speed_knots",
        instant(as_of).alias("computed_at"),
    )


def hourly_trend(clean: DataFrame) -> DataFrame:
    """Distinct keys, averages and emergencies per (hour, region)."""
    return clean.groupBy(F.date_trunc("hour", "ingested_at").alias("hour_bucket"), "region").agg(
        F.count_distinct("hex").alias("flight_count"),
        *_averages(),
        F.count_if(F.col("is_emergency")).alias("emergency_count"),
    )
