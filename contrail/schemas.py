"""Schemas of the documents and of every stored table."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
    "BINARY": T.BinaryType(),
}


def struct(text: str) -> T.StructType:
    """Schema from "name TYPE, ..." text; unlike ``fromDDL`` it needs no session."""
    fields = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# A snapshot document in either envelope. Elements stay JSON text, so that the
# original payload survives unchanged and no stray value can spoil a document.
DOCUMENT = struct(
    "now BIGINT, total BIGINT, ac ARRAY<STRING>, region STRING, region_label STRING, "
    "ingested_at STRING, api_url STRING, aircraft_count BIGINT, aircraft ARRAY<STRING>, "
    "_corrupt_record STRING"
)

# One element, every scalar as text: altitude is a number or 'ground', and feeds
# disagree on the rest. Casts happen in the flatteners.
ELEMENT_FIELDS = (
    "hex flight r t ownOp squawk category lat lon alt_baro alt_geom gs ias tas mach track "
    "track_rate roll baro_rate geom_rate nav_qnh nav_altitude_mcp nav_altitude_fms nav_heading "
    "nav_modes mlat seen seen_pos rssi messages emergency alert spi dbFlags "
    "_region _region_label _ingested_at _source_url"
).split()
ELEMENT = T.StructType([T.StructField(name, T.StringType()) for name in ELEMENT_FIELDS])

RAW_N = struct(
    "ingestion_id STRING, fetched_at TIMESTAMP, source_region STRING, api_endpoint STRING, "
    "hex STRING, flight STRING, lat DOUBLE, lon DOUBLE, alt_baro INT, alt_geom INT, gs DOUBLE, "
    "track DOUBLE, baro_rate INT, squawk STRING, emergency STRING, category STRING, "
    "registration STRING, aircraft_type STRING, ownop STRING, db_flags INT, nav_modes STRING, "
    "mlat STRING, seen DOUBLE, rssi DOUBLE, raw_payload STRING, _ingested_at TIMESTAMP, "
    "_source_file STRING"
)

RAW_L = struct(
    "hex STRING, flight STRING, registration STRING, aircraft_type STRING, squawk STRING, "
    "category STRING, lat DOUBLE, lon DOUBLE, alt_baro STRING, alt_geom DOUBLE, gs DOUBLE, "
    "ias DOUBLE, tas DOUBLE, mach DOUBLE, track DOUBLE, track_rate DOUBLE, roll DOUBLE, "
    "baro_rate DOUBLE, geom_rate DOUBLE, nav_qnh DOUBLE, nav_altitude_mcp DOUBLE, "
    "nav_altitude_fms DOUBLE, nav_heading DOUBLE, seen DOUBLE, seen_pos DOUBLE, rssi DOUBLE, "
    "messages BIGINT, emergency STRING, alert INT, spi INT, _region STRING, "
    "_region_label STRING, _ingested_at TIMESTAMP, _source_url STRING, _loaded_at TIMESTAMP, "
    "_source_file STRING, _raw_json STRING"
)

LANDING = struct("raw_json STRING, ingestion_time TIMESTAMP")

AUDIT = struct(
    "file_name STRING, region STRING, ingested_at TIMESTAMP, records_loaded INT, "
    "loaded_at TIMESTAMP, status STRING, error_msg STRING, file_path STRING"
)

CLEAN_N = struct(
    "ingestion_id STRING, fetched_at TIMESTAMP, source_region STRING, hex STRING, "
    "callsign STRING, lat DOUBLE, lon DOUBLE, alt_baro INT, gs DOUBLE, track DOUBLE, "
    "baro_rate INT, squawk STRING, registration STRING, aircraft_type STRING, "
    "airline_icao STRING, is_emergency BOOLEAN, is_military BOOLEAN, is_deleted BOOLEAN, "
    "deleted_at TIMESTAMP, deleted_reason STRING, _silver_loaded_at TIMESTAMP"
)

CLEAN_L = struct(
    "hex STRING, flight STRING, registration STRING, aircraft_type STRING, squawk STRING, "
    "category STRING, lat DOUBLE, lon DOUBLE, altitude_ft DOUBLE, on_ground BOOLEAN, "
    "gs_knots DOUBLE, track_deg DOUBLE, baro_rate DOUBLE, emergency STRING, "
    "is_emergency BOOLEAN, region STRING, region_label STRING, ingested_at TIMESTAMP, "
    "loaded_at TIMESTAMP, dq_missing_pos BOOLEAN, dq_missing_call BOOLEAN, "
    "dq_bad_alt BOOLEAN, dq_bad_speed BOOLEAN"
)

# Attributes copied from a clean observation into the state of its key.
ATTRIBUTES_N = (
    "callsign lat lon alt_baro gs track baro_rate squawk registration aircraft_type "
    "airline_icao source_region is_emergency is_military"
).split()
ATTRIBUTES_L = (
    "flight registration aircraft_type squawk lat lon altitude_ft on_ground gs_knots "
    "track_deg baro_rate emergency is_emergency region region_label"
).split()

CURRENT_N = struct(
    "hex STRING, callsign STRING, lat DOUBLE, lon DOUBLE, alt_baro INT, gs DOUBLE, track DOUBLE, "
    "baro_rate INT, squawk STRING, registration STRING, aircraft_type STRING, "
    "airline_icao STRING, source_region STRING, is_emergency BOOLEAN, is_military BOOLEAN, "
    "last_seen_at TIMESTAMP, is_deleted BOOLEAN, deleted_at TIMESTAMP, deleted_reason STRING, "
    "_updated_at TIMESTAMP"
)

CURRENT_L = struct(
    "hex STRING, flight STRING, registration STRING, aircraft_type STRING, squawk STRING, "
    "lat DOUBLE, lon DOUBLE, altitude_ft DOUBLE, on_ground BOOLEAN, gs_knots DOUBLE, "
    "track_deg DOUBLE, baro_rate DOUBLE, emergency STRING, is_emergency BOOLEAN, region STRING, "
    "region_label STRING, last_seen TIMESTAMP, updated_at TIMESTAMP, observed_at TIMESTAMP"
)

# Tracked columns: a change of any of them opens a new version.
TRACKED_N = "callsign registration aircraft_type airline_icao".split()
TRACKED_L = "flight registration squawk altitude_ft gs_knots lat lon".split()

HISTORY_N = struct(
    "flight_sk BIGINT, hex STRING, callsign STRING, registration STRING, aircraft_type STRING, "
    "airline_icao STRING, effective_from TIMESTAMP, effective_to TIMESTAMP, is_current BOOLEAN, "
    "is_deleted BOOLEAN, deleted_at TIMESTAMP, deleted_reason STRING"
)

HISTORY_L = struct(
    "history_id STRING, hex STRING, flight STRING, registration STRING, aircraft_type STRING, "
    "squawk STRING, lat DOUBLE, lon DOUBLE, altitude_ft DOUBLE, on_ground BOOLEAN, "
    "gs_knots DOUBLE, track_deg DOUBLE, baro_rate DOUBLE, emergency STRING, "
    "is_emergency BOOLEAN, region STRING, region_label STRING, observed_at TIMESTAMP, "
    "effective_from TIMESTAMP, effective_to TIMESTAMP, is_current BOOLEAN, change_reason STRING"
)

CDC_N = struct(
    "hex STRING, callsign STRING, change_type STRING, old_value STRING, new_value STRING, "
    "event_at TIMESTAMP, detected_at TIMESTAMP"
)

CDC_L = struct(
    "cdc_id STRING, hex STRING, flight STRING, cdc_event STRING, old_lat DOUBLE, new_lat DOUBLE, "
    "old_lon DOUBLE, new_lon DOUBLE, old_altitude_ft DOUBLE, new_altitude_ft DOUBLE, "
    "old_gs_knots DOUBLE, new_gs_knots DOUBLE, old_track_deg DOUBLE, new_track_deg DOUBLE, "
    "detected_at TIMESTAMP"
)

# Vanish marks: (key, life) pairs whose clean rows count as DISAPPEARED.
MARKS = struct("hex STRING, life INT, deleted_at TIMESTAMP")

COMMITS = struct(
    "version BIGINT, committed_at TIMESTAMP, operation STRING, operation_metrics STRING, "
    "source STRING"
)

METRICS_N = struct(
    "snapshot_at TIMESTAMP, metric_name STRING, dimension STRING, dimension_value STRING, "
    "metric_value DOUBLE"
)

ROUTES_N = struct(
    "callsign STRING, airline_icao STRING, aircraft_type STRING, total_observations BIGINT, "
    "avg_altitude DOUBLE, avg_speed DOUBLE, min_lat DOUBLE, max_lat DOUBLE, min_lon DOUBLE, "
    "max_lon DOUBLE, regions_seen STRING, computed_at TIMESTAMP"
)

# Columns that must never be NULL, per table.
REQUIRED = {
    "clean": ("hex", "fetched_at"),
    "current": ("hex",),
    "history": ("hex", "effective_from", "is_current"),
    "cdc": ("hex", "change_type", "detected_at"),
    "metrics": ("snapshot_at", "metric_name"),
}
