"""KPI snapshots, route profiles and grid hotspots (profile N)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import schemas
from contrail.functions import columns as C
from contrail.functions.time import instant
from contrail.operators.clean import live

TOP_OPERATORS = 10
TOP_ROUTES = 20


def scalar_kpis(current: DataFrame) -> DataFrame:
    """The eight scalar KPIs as one row, from one pass over the state."""
    deleted, reason = F.col("is_deleted"), F.col("deleted_reason")
    alive = ~deleted

    def live_only(name: str) -> Column:
        return F.when(alive, F.col(name))

    return current.agg(
        F.count_if(alive).alias("active_flights"),
        F.count_distinct(live_only("hex")).alias("aircraft_count"),
        F.round(F.avg(live_only("alt_baro")), 0).alias("avg_altitude"),
        F.round(F.avg(live_only("gs")), 1).alias("avg_speed"),
        F.count_if(alive & F.col("is_emergency")).alias("emergency_flights"),
        F.count_if(alive & F.col("is_military")).alias("military_flights"),
        F.count_if(deleted & (reason == C.DISAPPEARED)).alias("disappeared_aircraft"),
        C.percent(F.count_if(deleted), F.count(F.lit(1))).alias("disappearance_rate_pct"),
    )


def unpivot_row(row: DataFrame, name: str, value: str) -> DataFrame:
    """One wide row to (name, value) rows; values become DOUBLE."""
    wide = row.select(*[F.col(c).cast("double").alias(c) for c in row.columns])
    return wide.unpivot([], wide.columns, name, value)


def _group_count(df: DataFrame, metric: str, dimension: str, value: Column) -> DataFrame:
    return (
        df.groupBy(value.alias("dimension_value"))
        .agg(F.count(F.lit(1)).cast("double").alias("metric_value"))
        .select(
            F.lit(metric).alias("metric_name"),
            F.lit(dimension).alias("dimension"),
            "dimension_value",
            "metric_value",
        )
    )


def _top(df: DataFrame, k: int) -> DataFrame:
    return df.orderBy(F.desc("metric_value"), "dimension_value").limit(k)


def grouped_kpis(current: DataFrame, clean: DataFrame) -> DataFrame:
    """Groups of the state, and the commonest callsigns of the clean log."""
    return grouped_kpis_of(current, route_frequency(clean))


def grouped_kpis_of(current: DataFrame, routes: DataFrame) -> DataFrame:
    """Counts per airline, type, region, grid cell, altitude band and emergency code.

    All but the two top lists come from one pass over the state: each row emits
    its (metric, dimension, value) triples, which are counted on the map side
    first.
    """
    rows = live(current)
    unknown = F.lit("UNKNOWN")

    def triple(metric: str, dimension: str, value: Column, where: Column | None = None) -> Column:
        packed = F.struct(
            F.lit(metric).alias("metric_name"),
            F.lit(dimension).alias("dimension"),
            value.alias("dimension_value"),
        )
        return packed if where is None else F.when(where, packed)

    lat, lon, altitude = F.col("lat"), F.col("lon"), F.col("alt_baro")
    triples = F.array(
        triple("flights_by_airline", "airline_icao", F.coalesce("airline_icao", unknown)),
        triple("flights_by_type", "aircraft_type", F.coalesce("aircraft_type", unknown)),
        triple("flights_by_region", "source_region", F.coalesce("source_region", F.lit("None"))),
        triple("flight_density", "grid", C.grid_cell(lat, lon), lat.isNotNull() & lon.isNotNull()),
        triple("flights_by_altitude_band", "altitude_band", C.altitude_band(altitude), altitude.isNotNull()),
        triple("emergency_by_squawk", "squawk", F.coalesce("squawk", unknown), F.col("is_emergency")),
    )
    counted = (
        rows.select(F.explode(F.array_compact(triples)).alias("t"))
        .groupBy("t.metric_name", "t.dimension", "t.dimension_value")
        .agg(F.count(F.lit(1)).cast("double").alias("metric_value"))
    )
    airline = F.coalesce("airline_icao", unknown)
    operators = _top(_group_count(rows, "top_operators", "airline_icao", airline), TOP_OPERATORS)
    return counted.unionByName(operators).unionByName(routes)


def route_frequency(clean: DataFrame, k: int = TOP_ROUTES) -> DataFrame:
    named = live(clean).filter(F.col("callsign") != C.NO_CALLSIGN)
    return _top(_group_count(named, "route_frequency", "callsign", F.col("callsign")), k)


def kpi_snapshot(
    current: DataFrame, clean: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """All KPIs as narrow (metric, dimension, value) rows of one moment; NULL is 0."""
    return kpi_snapshot_of(current, route_frequency(clean), as_of)


def kpi_snapshot_of(
    current: DataFrame, routes: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """The snapshot with the commonest callsigns kept elsewhere."""
    scalars = unpivot_row(scalar_kpis(current), "metric_name", "metric_value").select(
        "metric_name",
        F.lit(None).cast("string").alias("dimension"),
        F.lit(None).cast("string").alias("dimension_value"),
        F.coalesce("metric_value", F.lit(0.0)).alias("metric_value"),
    )
    facts = scalars.unionByName(grouped_kpis_of(current, routes))
    return facts.withColumn("snapshot_at", F.date_trunc("second", instant(as_of))).select(
        *schemas.METRICS_N.names
    )


def route_summary(clean: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Profile per (callsign, airline, type): counts, averages, bounding box, regions.

    The set of regions per route is bounded by the roster, and is merged on the
    map side.
    """
    named = live(clean).filter(F.col("callsign") != C.NO_CALLSIGN)
    return named.groupBy("callsign", "airline_icao", "aircraft_type").agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.round(F.avg("alt_baro"), 0).alias("avg_altitude"),
        F.round(F.avg("gs"), 1).alias("avg_speed"),
        F.min("lat").alias("min_lat"),
        F.max("lat").alias("max_lat"),
        F.min("lon").alias("min_lon"),
        F.max("lon").alias("max_lon"),
        F.array_join(F.array_sort(F.collect_set("source_region")), ", ").alias("regions_seen"),
        instant(as_of).alias("computed_at"),
    )


def hotspots(current: DataFrame, cell_deg: int = 1, as_of: datetime | None = None) -> DataFrame:
    """Live keys per grid cell."""
    placed = live(current).filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return (
        placed.groupBy(
            C.grid_index(F.col("lat"), cell_deg).alias("lat_bucket"),
            C.grid_index(F.col("lon"), cell_deg).alias("lon_bucket"),
        )
        .agg(
            F.count(F.lit(1)).alias("flight_count"),
            F.round(F.avg("alt_baro"), 0).alias("avg_altitude"),
            F.count_if(F.col("is_emergency")).alias("emergency_count"),
            F.count_if(F.col("is_military")).alias("military_count"),
        )
        .select(
            F.concat_ws("_", "lat_bucket", "lon_bucket").alias("grid_cell"),
            "*",
            instant(as_of).alias("computed_at"),
        )
    )
