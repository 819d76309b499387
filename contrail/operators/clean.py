"""Raw observations to clean observations, in both profiles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import schemas
from contrail.functions import columns as C
from contrail.functions.time import instant, is_corrupt_time
from contrail.operators.keyed import flag_duplicates, latest_per_key, lookup


def clean_observations(
    raw: DataFrame,
    profile: str = "N",
    since: datetime | Column | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Apply the cleaning rules of a profile.

    ``since`` keeps only rows strictly newer than the mark (a time, or a column
    such as :func:`high_water_mark`); without it everything is cleaned afresh.
    """
    if profile == "L":
        return _clean_l(_newer(raw, "_ingested_at", since))
    return _clean_n(_newer(raw, "fetched_at", since), as_of)


def high_water_mark(clean: DataFrame, time: str = "fetched_at") -> Column:
    """Newest time already cleaned, as a scalar subquery; 1970 for an empty table."""
    epoch = instant(datetime(1970, 1, 1))
    return clean.agg(F.coalesce(F.max(time), epoch).alias("mark")).scalar()


def _newer(raw: DataFrame, time: str, since: datetime | Column | None) -> DataFrame:
    if since is None:
        return raw
    mark = instant(since) if isinstance(since, datetime) else since
    return raw.filter(F.col(time) > mark)


def _clean_n(raw: DataFrame, as_of: datetime | None) -> DataFrame:
    rows = flag_duplicates(raw.filter(F.col("hex").isNotNull()))
    invalid = C.invalid_position(F.col("lat"), F.col("lon"))
    reason = F.when(invalid, C.INVALID_POSITION).when(F.col("is_duplicate"), C.DUPLICATE)
    picked = {
        "callsign": C.callsign_or_unknown(F.col("flight")),
        "alt_baro": C.keep_within(F.col("alt_baro"), C.ALTITUDE_RANGE["N"]),
        "gs": C.keep_within(F.col("gs"), C.SPEED_RANGE["N"]),
        "registration": F.coalesce("registration", F.lit(C.NO_REGISTRATION)),
        "airline_icao": C.operator_prefix(F.col("flight")),
        "is_emergency": C.emergency_by_code(F.col("squawk"), F.col("emergency")),
        "is_military": C.military_bit(F.col("db_flags")),
        "is_deleted": invalid | F.col("is_duplicate"),
        "deleted_at": F.when(invalid | F.col("is_duplicate"), instant(as_of)),
        "deleted_reason": reason,
        "_silver_loaded_at": instant(as_of),
    }
    return rows.select(*[picked.get(n, F.col(n)).alias(n) for n in schemas.CLEAN_N.names])


def _clean_l(raw: DataFrame) -> DataFrame:
    # The text is cast once, in a projection of its own: a text that is no number costs an exception each time.
    raw = raw.filter(F.col("hex").isNotNull()).withColumn("_feet", C.lenient_double(F.col("alt_baro")))
    altitude, feet, speed = F.col("alt_baro"), F.col("_feet"), F.col("gs")
    lat, lon = F.col("lat"), F.col("lon")
    limits = C.ALTITUDE_RANGE["L"]
    picked = {
        "hex": F.lower(F.trim("hex")),
        "flight": C.tidy_upper(F.col("flight")),
        "registration": C.tidy_upper(F.col("registration")),
        "aircraft_type": C.tidy_upper(F.col("aircraft_type")),
        "squawk": C.tidy(F.col("squawk")),
        "category": C.tidy(F.col("category")),
        "lat": C.keep_within(lat, C.LAT_RANGE),
        "lon": C.keep_within(lon, C.LON_RANGE),
        "altitude_ft": F.when(C.on_ground(altitude), F.lit(0.0)).otherwise(C.keep_within(feet, limits)),
        "on_ground": C.on_ground(altitude),
        "gs_knots": C.keep_within(speed, C.SPEED_RANGE["L"]),
        "track_deg": F.col("track"),
        "emergency": F.nullif(F.lower(F.trim("emergency")), F.lit("none")),
        "is_emergency": C.emergency_by_text(F.col("emergency")),
        "region": F.col("_region"),
        "region_label": F.col("_region_label"),
        "ingested_at": F.col("_ingested_at"),
        "loaded_at": F.col("_loaded_at"),
        "dq_missing_pos": lat.isNull() | lon.isNull(),
        "dq_missing_call": F.col("flight").isNull(),
        "dq_bad_alt": ~feet.between(*limits) & ~C.on_ground(altitude),
        "dq_bad_speed": speed.isNull() | ~speed.between(*C.SPEED_RANGE["L"]),
    }
    return raw.select(*[picked.get(n, F.col(n)).alias(n) for n in schemas.CLEAN_L.names])


def new_keys_only(rows: DataFrame, known: DataFrame, key: str = "hex") -> DataFrame:
    """Rows whose key is not known yet."""
    return lookup(rows, known.select(key).distinct(), [key], "left_anti")


def live(df: DataFrame) -> DataFrame:
    return df.filter("is_deleted = false")


def latest_observation(clean: DataFrame, profile: str = "N") -> DataFrame:
    """Newest usable observation per key, shaped for the state tables."""
    if profile == "L":
        order = [F.desc("ingested_at"), F.desc("loaded_at"), F.xxhash64(*schemas.ATTRIBUTES_L)]
        latest = latest_per_key(clean, ["hex"], order)
        return latest.select("hex", *schemas.ATTRIBUTES_L, F.col("ingested_at").alias("observed_at"))
    order = [F.desc("fetched_at"), F.col("ingestion_id")]
    latest = latest_per_key(live(clean), ["hex"], order)
    return latest.select("hex", *schemas.ATTRIBUTES_N, F.col("fetched_at").alias("last_seen_at"))


def quarantine(raw: DataFrame, time: str = "fetched_at") -> tuple[DataFrame, DataFrame]:
    """(usable, corrupt) rows by the plausibility of their time."""
    corrupt = F.coalesce(is_corrupt_time(F.col(time)), F.lit(False))
    return raw.filter(~corrupt), raw.filter(corrupt)


def load_stats(clean: DataFrame) -> DataFrame:
    """Total, active, invalid, duplicate and soft-deleted rows in one pass."""
    reason = F.col("deleted_reason")
    return clean.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("is_deleted")).alias("active"),
        F.count_if(reason == C.INVALID_POSITION).alias("invalid_coords"),
        F.count_if(reason == C.DUPLICATE).alias("duplicates"),
        F.count_if(F.col("is_deleted")).alias("soft_deleted"),
    )
