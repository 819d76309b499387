"""The query library: parameterised reads of the state, logs and marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail import schemas
from contrail.functions import columns as C
from contrail.functions.time import instant, micros, minus_hours

def _first(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def _in_region(df: DataFrame, region: str | None) -> DataFrame:
    return df.filter(F.col("region") == region) if region else df


def live_flights(
    current: DataFrame,
    region: str | None = None,
    emergency_only: bool = False,
    airborne_only: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Current positions, newest first."""
    rows = _in_region(current, region)
    if emergency_only:
        rows = rows.filter("is_emergency = true")
    if airborne_only:
        rows = rows.filter("on_ground = false")
    rows = rows.select("hex", *schemas.ATTRIBUTES_L, "last_seen", "updated_at")
    return _first(rows.orderBy(F.desc("last_seen"), "hex"), limit)


def page_clean(
    clean: DataFrame, region: str | None = None, limit: int | None = None, offset: int = 0
) -> DataFrame:
    """One page of the clean log, newest first."""
    rows = _in_region(clean, region).orderBy(F.desc("ingested_at"), "hex")
    return _first(rows.offset(offset) if offset else rows, limit)


def log_by_time(clean: DataFrame) -> DataFrame:
    """The clean log for paging: ranges of time, sorted, with ``row_no`` telling apart rows of one time and key.

    Written as it is, every file and row group holds a short stretch of time.
    """
    tie = F.xxhash64(*[c for c in clean.columns if c not in ("ingested_at", "hex")])
    same = Window.partitionBy("ingested_at", "hex").orderBy(tie)
    numbered = clean.withColumn("row_no", F.row_number().over(same))
    return numbered.repartitionByRange("ingested_at").sortWithinPartitions(F.desc("ingested_at"), "hex", "row_no")


def page_after(
    log: DataFrame,
    cursor: tuple[datetime, str, int] | None = None,
    limit: int = 100,
    region: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The ``limit`` rows behind the cursor, newest first, whatever the depth.

    ``log`` is the stored :func:`log_by_time`; the cursor is (ingested_at, hex,
    row_no) of the last row of the page before, None for the first page. Rows
    without a time are on no page. ``counts`` (metric_time, region, total_flights),
    the minute mart, bounds the scan below as well: the page cannot reach further
    back than the minutes that hold ``limit`` rows. Both bounds reach the row groups.
    """
    rows = _in_region(log, region).filter("ingested_at IS NOT NULL")
    if cursor:
        at, key, number = F.lit(micros(cursor[0])), F.lit(cursor[1]), F.lit(cursor[2])
        at = F.timestamp_micros(at)
        later = (F.col("hex") > key) | ((F.col("hex") == key) & (F.col("row_no") > number))
        rows = rows.filter((F.col("ingested_at") < at) | ((F.col("ingested_at") == at) & later))
        rows = rows.filter(F.col("ingested_at") <= at)  # by itself, so that it is pushed down
    if counts is not None:
        rows = rows.filter(F.col("ingested_at") >= _page_floor(_in_region(counts, region), cursor, limit))
    return rows.orderBy(F.desc("ingested_at"), "hex", "row_no").limit(limit)


def _page_floor(counts: DataFrame, cursor: tuple | None, limit: int) -> Column:
    """Start of the newest minutes that hold ``limit`` rows before the cursor's; NULL-free."""
    per = counts.filter("metric_time IS NOT NULL").groupBy("metric_time").agg(F.sum("total_flights").alias("n"))
    if cursor:
        # The cursor's own minute may be read in part, so it counts for nothing.
        per = per.filter(F.col("metric_time") < F.date_trunc("minute", F.timestamp_micros(F.lit(micros(cursor[0])))))
    # No more than ``limit`` minutes with a row can be needed.
    newest = per.filter("n > 0").orderBy(F.desc("metric_time")).limit(limit)
    running = F.sum("n").over(Window.orderBy(F.desc("metric_time")))
    enough = newest.withColumn("upto", running).filter(F.col("upto") >= limit).agg(F.max("metric_time").alias("t"))
    least = F.lit("0001-01-01 00:00:00").cast("timestamp")
    return enough.select(F.coalesce("t", least).alias("t")).scalar()


def key_history(history: DataFrame, key: str) -> DataFrame:
    """All versions of one key, newest first, with their number."""
    rows = history.filter(F.col("hex") == key.lower())
    return rows.withColumn(
        "version_count", rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    ).orderBy(F.desc("effective_from"))


def aircraft(dim: DataFrame, limit: int | None = None) -> DataFrame:
    return _first(dim.orderBy(F.desc("last_seen"), "hex"), limit)


def airlines(dim: DataFrame) -> DataFrame:
    return dim.orderBy(F.desc("flight_count"), "callsign_prefix")


def _within_hours(df: DataFrame, time: str, hours: int, as_of: datetime | None) -> DataFrame:
    return df.filter(F.col(time) >= minus_hours(instant(as_of), hours))


def metrics_window(
    metrics: DataFrame, region: str | None = None, hours: int = 24, as_of: datetime | None = None
) -> DataFrame:
    """Minute metrics of the last hours, newest first."""
    rows = _within_hours(_in_region(metrics, region), "metric_time", hours, as_of)
    return rows.orderBy(F.desc("metric_time"), "region")


def kpi_list(kpis: DataFrame) -> DataFrame:
    return kpis.orderBy("kpi_name")


def kpi_value(kpis: DataFrame, name: str, digits: int | None = None) -> DataFrame:
    """A single KPI."""
    value = F.col("kpi_value") if digits is None else F.round("kpi_value", digits)
    return kpis.filter(F.col("kpi_name") == name).select(value.alias("kpi_value"))


def alerts(current: DataFrame) -> DataFrame:
    """Keys that declare an emergency, newest first."""
    return (
        current.filter("is_emergency = true")
        .select(
            "hex", "flight", "registration", "aircraft_type", "squawk", "lat", "lon",
            "altitude_ft", "gs_knots", "emergency", "region", "region_label", "last_seen",
        )
        .orderBy(F.desc("last_seen"), "hex")
    )


def cdc_like(cdc: DataFrame, text: str | None = None, limit: int | None = None) -> DataFrame:
    """Change events whose kind contains the text, newest first."""
    rows = cdc.filter(F.col("cdc_event").contains(text)) if text else cdc
    return _first(rows.orderBy(F.desc("detected_at"), "hex"), limit)


def regions(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.desc("total_flights"), "region")


def region_shares(summary: DataFrame) -> DataFrame:
    return regions(summary).select(F.col("region_label").alias("region"), "total_flights")


def operators(top: DataFrame, limit: int | None = None) -> DataFrame:
    """Ranked operators; with a limit only name and count."""
    rows = top.orderBy("rank")
    return rows.limit(limit).select("operator", "flight_count") if limit else rows


def trend_window(
    trend: DataFrame, region: str | None = None, hours: int = 48, as_of: datetime | None = None
) -> DataFrame:
    """Hourly trend of the last hours, oldest first."""
    rows = _within_hours(_in_region(trend, region), "hour_bucket", hours, as_of)
    return rows.orderBy("hour_bucket", "region")


def geojson(current: DataFrame) -> DataFrame:
    """One GeoJSON feature per placed key, as (hex, feature) text.

    A whole collection would be one unbounded value, so the features stay rows;
    write them as lines. :func:`feature_count` gives the collection's size.
    """
    properties = F.struct(
        "hex", "flight", "registration", "aircraft_type", "altitude_ft", "gs_knots", "track_deg",
        "on_ground", "is_emergency", "emergency", "region",
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")
        ).alias("geometry"),
        properties.alias("properties"),
    )
    keep_nulls = {"ignoreNullFields": "false"}
    placed = current.filter("lat IS NOT NULL AND lon IS NOT NULL")
    return placed.select("hex", F.to_json(feature, keep_nulls).alias("feature"))


def feature_count(current: DataFrame) -> DataFrame:
    """Size of the collection :func:`geojson` gives."""
    placed = current.filter("lat IS NOT NULL AND lon IS NOT NULL")
    return placed.agg(F.lit("FeatureCollection").alias("type"), F.count(F.lit(1)).alias("count"))


def trend_counts(trend: DataFrame) -> DataFrame:
    return trend.select(F.col("hour_bucket").alias("time"), "flight_count", "region").orderBy(
        "time", "region"
    )


def trend_averages(trend: DataFrame) -> DataFrame:
    return trend.select(
        F.col("hour_bucket").alias("time"), "region", "avg_altitude_ft", "avg_speed_knots"
    ).orderBy("time", "region")


def live_table(current: DataFrame, limit: int | None = None) -> DataFrame:
    """Rounded positions for display."""
    return (
        _first(current.orderBy(F.desc("last_seen"), "hex"), limit)
        .select(
            "hex", "flight", "registration", "aircraft_type",
            F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"),
            "altitude_ft", F.round("gs_knots", 0).alias("speed_kts"), "track_deg", "on_ground",
            "emergency", "region",
        )
    )


def measures(current: DataFrame) -> DataFrame:
    """Fleet measures in one row. ``unique_airlines`` counts whole callsigns.

    A missing type or callsign counts as one more distinct value.
    """
    emergency = F.count_if(F.col("is_emergency"))
    total = F.count(F.lit(1))

    def distinct_with_blank(name: str) -> Column:
        blank = F.max(F.col(name).isNull().cast("int"))
        return F.count_distinct(name) + F.coalesce(blank, F.lit(0))

    return current.agg(
        total.alias("active_flights"),
        F.avg("altitude_ft").alias("avg_altitude_ft"),
        F.avg("gs_knots").alias("avg_speed_knots"),
        emergency.alias("emergency_count"),
        F.count_if(~F.col("on_ground")).alias("airborne_count"),
        F.count_if(F.col("on_ground")).alias("on_ground_count"),
        distinct_with_blank("aircraft_type").alias("unique_aircraft_types"),
        distinct_with_blank("flight").alias("unique_airlines"),
        (C.safe_ratio(emergency, total) * 100).alias("emergency_rate_pct"),
    )


def type_distribution(current: DataFrame) -> DataFrame:
    return current.groupBy("aircraft_type").agg(F.count("hex").alias("count"))


def top_callsigns(current: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent callsigns with every tie of the last one.

    The k-th count is found by a top-k, then compared as a scalar, so no window
    over all callsigns is needed.
    """
    counts = current.groupBy("flight").agg(F.count("hex").alias("flights"))
    kth = counts.orderBy(F.desc("flights")).limit(k).agg(F.min("flights").alias("least"))
    return counts.filter(F.col("flights") >= kth.scalar())


def total_hourly_flights(trend: DataFrame) -> DataFrame:
    return trend.agg(F.sum("flight_count").alias("hourly_flight_count"))


def growth_day_over_day(trend: DataFrame) -> DataFrame:
    """Per day: its busiest hour against that of the day before, in percent (0 if none)."""
    daily = trend.groupBy(F.to_date("hour_bucket").alias("day")).agg(
        F.max("flight_count").alias("flights")
    )
    before = daily.select(F.date_add("day", 1).alias("day"), F.col("flights").alias("flights_before"))
    growth = C.safe_ratio(F.col("flights") - F.col("flights_before"), F.col("flights_before")) * 100
    return daily.join(before, "day", "left").withColumn("growth_pct", growth)


def squawk_distribution(current: DataFrame) -> DataFrame:
    return current.groupBy("squawk").agg(F.count(F.lit(1)).alias("count"))


def emergencies_by_hour(trend: DataFrame) -> DataFrame:
    return trend.groupBy("hour_bucket").agg(F.sum("emergency_count").alias("emergency_count"))


def event_counts(cdc: DataFrame, kind: str = "cdc_event") -> DataFrame:
    return cdc.groupBy(kind).agg(F.count(F.lit(1)).alias("count"))


def typed_trend(trend: DataFrame) -> DataFrame:
    """The hourly trend with the column types reports expect."""
    return trend.select(
        F.col("hour_bucket").cast("timestamp"), "region", F.col("flight_count").cast("bigint"),
        F.col("avg_altitude_ft").cast("double"), "avg_speed_knots", "emergency_count",
    ).orderBy("hour_bucket", "region")
