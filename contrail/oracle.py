"""The same queries as SQL over the given tables, for the side-by-side check.

Written from the semantics, not from the Spark code: ranks by window over whole
tables, set membership by NOT IN, versions by plain joins.
"""

from __future__ import annotations

SPLIT = "TIMESTAMP '2024-01-16'"
AS_OF = "TIMESTAMP '2024-01-31'"
GRACE = "INTERVAL 720 MINUTE"
WINDOW = "INTERVAL 14400 MINUTE"
HOURS = "INTERVAL 100 HOUR"

_ATTR_N = (
    "callsign, lat, lon, alt_baro, gs, track, baro_rate, squawk, registration, aircraft_type, "
    "airline_icao, source_region, is_emergency, is_military"
)
_ATTR_L = (
    "flight, registration, aircraft_type, squawk, lat, lon, altitude_ft, on_ground, gs_knots, "
    "track_deg, baro_rate, emergency, is_emergency, region, region_label"
)


def _prefixed(alias: str, columns: str) -> str:
    return ", ".join(f"{alias}.{c.strip()}" for c in columns.split(","))


def _latest_n(source: str) -> str:
    return f"""
    SELECT hex, {_ATTR_N}, fetched_at AS last_seen_at FROM (
      SELECT *, row_number() OVER (PARTITION BY hex ORDER BY fetched_at DESC, ingestion_id) AS r
      FROM {source} WHERE NOT is_deleted) WHERE r = 1"""


def _latest_l(source: str) -> str:
    return f"""
    SELECT hex, {_ATTR_L}, ingested_at AS observed_at FROM (
      SELECT *, row_number() OVER (PARTITION BY hex ORDER BY ingested_at DESC) AS r
      FROM {source}) WHERE r = 1"""


def _fresh_state(latest: str, at: str) -> str:
    return f"""
    SELECT *, FALSE AS is_deleted, CAST(NULL AS TIMESTAMP) AS deleted_at,
           CAST(NULL AS VARCHAR) AS deleted_reason, {at} AS _updated_at FROM {latest}"""


def _merge(state: str, latest: str, at: str) -> str:
    attrs = ", ".join(
        f"CASE WHEN n.hex IS NULL THEN o.{c.strip()} ELSE n.{c.strip()} END AS {c.strip()}"
        for c in f"{_ATTR_N}, last_seen_at".split(",")
    )
    return f"""
    SELECT COALESCE(n.hex, o.hex) AS hex, {attrs},
           CASE WHEN n.hex IS NULL THEN o.is_deleted ELSE FALSE END AS is_deleted,
           CASE WHEN n.hex IS NULL THEN o.deleted_at END AS deleted_at,
           CASE WHEN n.hex IS NULL THEN o.deleted_reason END AS deleted_reason,
           CASE WHEN n.hex IS NULL THEN o._updated_at ELSE {at} END AS _updated_at
    FROM {state} o FULL OUTER JOIN {latest} n ON o.hex = n.hex"""


def _gone(state: str, raw: str) -> str:
    return f"""
    SELECT hex, callsign, last_seen_at FROM {state}
    WHERE NOT is_deleted
      AND last_seen_at < (SELECT max(fetched_at) FROM {raw}) - {GRACE}
      AND hex NOT IN (SELECT hex FROM {raw} WHERE fetched_at = (SELECT max(fetched_at) FROM {raw}))"""


def _set_state(state: str, keys: str, deleted: str, reason: str, at: str) -> str:
    stamp = at if deleted == "TRUE" else "CAST(NULL AS TIMESTAMP)"
    return f"""
    SELECT hex, {_ATTR_N}, last_seen_at,
      CASE WHEN hex IN (SELECT hex FROM {keys}) THEN {deleted} ELSE is_deleted END AS is_deleted,
      CASE WHEN hex IN (SELECT hex FROM {keys}) THEN {stamp} ELSE deleted_at END AS deleted_at,
      CASE WHEN hex IN (SELECT hex FROM {keys}) THEN {reason} ELSE deleted_reason END AS deleted_reason,
      CASE WHEN hex IN (SELECT hex FROM {keys}) THEN {at} ELSE _updated_at END AS _updated_at
    FROM {state}"""


_HIST_N = "callsign, registration, aircraft_type, airline_icao"


def _history_n(differs: str) -> str:
    """Two steps: versions opened by the first half, then compared with everything."""
    tail = "FALSE AS is_deleted, CAST(NULL AS TIMESTAMP) AS deleted_at, CAST(NULL AS VARCHAR) AS deleted_reason"
    changed = f"a.hex IN (SELECT a.hex FROM latest_n1 a JOIN latest_n b USING (hex) WHERE {differs})"
    return f"""
    SELECT a.hex, {_prefixed('a', _HIST_N)}, {SPLIT} AS effective_from,
           CASE WHEN {changed} THEN {AS_OF} END AS effective_to, NOT ({changed}) AS is_current, {tail}
    FROM latest_n1 a
    UNION ALL
    SELECT b.hex, {_prefixed('b', _HIST_N)}, {AS_OF}, NULL, TRUE, {tail}
    FROM latest_n b LEFT JOIN latest_n1 a USING (hex)
    WHERE a.hex IS NULL OR {differs}"""


_TRACK_N = [c.strip() for c in _HIST_N.split(",")]
_DIFFERS = "(" + " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _TRACK_N) + ")"
_DIFFERS_PLAIN = "COALESCE(" + " OR ".join(f"COALESCE(a.{c} <> b.{c}, FALSE)" for c in _TRACK_N) + ", FALSE)"
_TRACK_L = "flight registration squawk altitude_ft gs_knots lat lon".split()
_REASON_L = "concat_ws(',', " + ", ".join(
    f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _TRACK_L
) + ")"

_CTES = {
    "e": """
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CAST(ts AS TIMESTAMP) AS event_ts FROM events""",
    "base": """
    SELECT event_id, event_type, k, event_ts,
      lpad(CAST(event_id AS VARCHAR), 14, '0') AS ingestion_id,
      'h' || CAST(user_id AS VARCHAR) AS hex,
      list_extract(['delhi', 'mumbai', 'hyderabad', 'bangalore'], k % 4 + 1) AS region,
      CASE WHEN k % 13 = 0 THEN NULL WHEN k % 11 = 0 THEN '   '
           ELSE list_extract(['ai', 'SG', 'IGO', 'uae', 'B'], user_id % 5 + 1)
                || CAST(user_id % 50 + k % 2 AS VARCHAR) || '  ' END AS flight,
      CASE WHEN event_id % 41 <> 0 THEN (event_id * 37 % 1600) / CAST(8 AS DOUBLE) - 100 END AS lat,
      (event_id * 53 % 3200) / CAST(8 AS DOUBLE) - 200 AS lon,
      CASE WHEN k % 17 = 0 THEN 'ground' WHEN k % 19 = 0 THEN 'bad' WHEN k % 23 = 0 THEN NULL
           ELSE CAST(k * 700 - 1400 AS VARCHAR) END AS alt_text,
      CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN CAST(-1 AS DOUBLE)
           ELSE floor(value * 16) / CAST(4 AS DOUBLE) END AS gs,
      CAST(event_id * 17 % 360 AS DOUBLE) AS track,
      CAST((event_id % 41 - 20) * 64 AS INTEGER) AS baro_rate,
      CASE WHEN event_type = 'error' AND k % 5 = 0 THEN '7700' WHEN k % 7 = 0 THEN NULL
           ELSE CAST(1000 + k * 11 AS VARCHAR) END AS squawk,
      CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error' AND k % 3 = 0 THEN 'general'
           WHEN event_type = 'view' AND k % 2 = 0 THEN '' ELSE 'none' END AS emergency,
      CASE WHEN user_id % 6 <> 0 THEN 'vt-' || CAST(user_id AS VARCHAR) END AS registration,
      list_extract(['b738', 'a20n', 'at76', NULL],
                   (user_id + CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END) % 4 + 1) AS aircraft_type,
      'A' || CAST(user_id % 6 AS VARCHAR) AS category,
      CASE WHEN event_id % 23 <> 0 THEN (event_id * 7 % 64) / CAST(8 AS DOUBLE) END AS seen,
      CASE WHEN user_id % 9 <> 0 THEN CAST(user_id % 4 AS INTEGER) END AS db_flags
    FROM e""",
    "raw_n": r"""
    SELECT ingestion_id, date_trunc('hour', event_ts) AS fetched_at, region AS source_region, hex,
      flight, lat, lon,
      CASE WHEN regexp_full_match(alt_text, '-?\d+') THEN CAST(alt_text AS INTEGER) END AS alt_baro,
      gs, track, baro_rate, squawk, emergency, registration, aircraft_type, category, seen, db_flags
    FROM base""",
    "raw_n1": f"SELECT * FROM raw_n WHERE fetched_at < {SPLIT}",
    "raw_n2": f"SELECT * FROM raw_n WHERE fetched_at >= {SPLIT}",
    "ranked": """
    SELECT *, row_number() OVER (
        PARTITION BY hex, fetched_at ORDER BY seen NULLS LAST, ingestion_id) AS rn,
      (lat IS NULL OR lon IS NULL OR lat < -90 OR lat > 90 OR lon < -180 OR lon > 180) AS bad
    FROM raw_n""",
    "clean_n": f"""
    SELECT ingestion_id, fetched_at, source_region, hex,
      CASE WHEN trim(flight) <> '' THEN trim(flight) ELSE 'UNKNOWN' END AS callsign, lat, lon,
      CASE WHEN alt_baro BETWEEN -1000 AND 60000 THEN alt_baro END AS alt_baro,
      CASE WHEN gs BETWEEN 0 AND 1200 THEN gs END AS gs, track, baro_rate, squawk,
      COALESCE(registration, 'UNREGISTERED') AS registration, aircraft_type,
      CASE WHEN length(trim(flight)) >= 3 THEN upper(substr(trim(flight), 1, 3)) END AS airline_icao,
      (squawk IN ('7500', '7600', '7700')
        OR (emergency IS NOT NULL AND emergency NOT IN ('none', ''))) AS is_emergency,
      (COALESCE(db_flags, 0) & 1) = 1 AS is_military,
      (bad OR rn > 1) AS is_deleted,
      CASE WHEN bad OR rn > 1 THEN {AS_OF} END AS deleted_at,
      CASE WHEN bad THEN 'INVALID_COORDS' WHEN rn > 1 THEN 'DUPLICATE' END AS deleted_reason,
      {AS_OF} AS _silver_loaded_at
    FROM ranked""",
    "clean_n1": f"SELECT * FROM clean_n WHERE fetched_at < {SPLIT}",
    "clean_n2": f"SELECT * FROM clean_n WHERE fetched_at >= {SPLIT}",
    "latest_n": _latest_n("clean_n"),
    "latest_n1": _latest_n("clean_n1"),
    "latest_n2": _latest_n("clean_n2"),
    "merged_1": _fresh_state("latest_n1", SPLIT),
    "gone_1": _gone("merged_1", "raw_n1"),
    "state_1": _set_state("merged_1", "gone_1", "TRUE", "'DISAPPEARED'", SPLIT),
    "merged_n": _fresh_state("latest_n", AS_OF),
    "gone_n": _gone("merged_n", "raw_n"),
    "state_n": _set_state("merged_n", "gone_n", "TRUE", "'DISAPPEARED'", AS_OF),
    "returned": """
    SELECT hex, callsign FROM state_1 WHERE is_deleted AND deleted_reason = 'DISAPPEARED' AND hex IN (
      SELECT hex FROM raw_n2 WHERE fetched_at = (SELECT max(fetched_at) FROM raw_n2))""",
    "woken": _set_state("state_1", "returned", "FALSE", "NULL", AS_OF),
    "merged_2": _merge("woken", "latest_n2", AS_OF),
    "gone_2": _gone("merged_2", "raw_n2"),
    "state_2": _set_state("merged_2", "gone_2", "TRUE", "'DISAPPEARED'", AS_OF),
    "history_n": _history_n(_DIFFERS),
    "events_n": f"""
    SELECT hex, callsign, 'DISAPPEARED' AS change_type,
           strftime(last_seen_at, '%Y-%m-%d %H:%M:%S') AS old_value, CAST(NULL AS VARCHAR) AS new_value,
           last_seen_at AS event_at, {AS_OF} AS detected_at FROM gone_n""",
    "raw_l": """
    SELECT CASE WHEN event_id % 7 = 0 THEN ' ' || upper(hex) || ' ' ELSE hex END AS hex,
      NULLIF(trim(flight), '') AS flight, registration, aircraft_type, squawk, category, lat, lon,
      alt_text AS alt_baro, gs, track, CAST(baro_rate AS DOUBLE) AS baro_rate, emergency,
      region AS _region, upper(region[1]) || substr(region, 2) AS _region_label,
      event_ts AS _ingested_at, date_trunc('hour', event_ts) AS _loaded_at
    FROM base""",
    "clean_l": """
    SELECT lower(trim(hex)) AS hex, NULLIF(upper(trim(flight)), '') AS flight,
      NULLIF(upper(trim(registration)), '') AS registration,
      NULLIF(upper(trim(aircraft_type)), '') AS aircraft_type,
      NULLIF(trim(squawk), '') AS squawk, NULLIF(trim(category), '') AS category,
      CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS lat,
      CASE WHEN lon BETWEEN -180 AND 180 THEN lon END AS lon,
      CASE WHEN lower(alt_baro) = 'ground' THEN CAST(0 AS DOUBLE)
           WHEN TRY_CAST(alt_baro AS DOUBLE) BETWEEN -500 AND 60000
           THEN TRY_CAST(alt_baro AS DOUBLE) END AS altitude_ft,
      lower(alt_baro) = 'ground' AS on_ground,
      CASE WHEN gs BETWEEN 0 AND 1500 THEN gs END AS gs_knots, track AS track_deg, baro_rate,
      NULLIF(lower(trim(emergency)), 'none') AS emergency,
      (emergency IS NOT NULL AND lower(trim(emergency)) NOT IN ('none', '')) AS is_emergency,
      _region AS region, _region_label AS region_label, _ingested_at AS ingested_at,
      _loaded_at AS loaded_at,
      (lat IS NULL OR lon IS NULL) AS dq_missing_pos, flight IS NULL AS dq_missing_call,
      (TRY_CAST(alt_baro AS DOUBLE) NOT BETWEEN -500 AND 60000 AND lower(alt_baro) <> 'ground') AS dq_bad_alt,
      (gs IS NULL OR gs NOT BETWEEN 0 AND 1500) AS dq_bad_speed
    FROM raw_l WHERE hex IS NOT NULL""",
    "clean_l1": f"SELECT * FROM clean_l WHERE ingested_at < {SPLIT}",
    "latest_l": _latest_l("clean_l"),
    "latest_l1": _latest_l("clean_l1"),
    "moved_l": f"SELECT b.hex, {_REASON_L} AS cols FROM latest_l1 a JOIN latest_l b USING (hex)",
    "history_l": f"""
    SELECT a.hex || '_2024-01-16T00:00:00+00:00' AS history_id, a.hex, {_prefixed('a', _ATTR_L)},
      a.observed_at, {SPLIT} AS effective_from,
      CASE WHEN m.cols <> '' THEN {AS_OF} END AS effective_to, COALESCE(m.cols = '', TRUE) AS is_current,
      'INITIAL_LOAD' AS change_reason
    FROM latest_l1 a LEFT JOIN moved_l m USING (hex)
    UNION ALL
    SELECT b.hex || '_2024-01-31T00:00:00+00:00', b.hex, {_prefixed('b', _ATTR_L)}, b.observed_at,
      {AS_OF}, NULL, TRUE, CASE WHEN m.hex IS NULL THEN 'INITIAL_LOAD' ELSE 'CHANGED:' || m.cols END
    FROM latest_l b LEFT JOIN moved_l m USING (hex) WHERE m.hex IS NULL OR m.cols <> ''""",
    "current_l": f"""
    SELECT hex, {_ATTR_L}, effective_from AS last_seen, effective_from AS updated_at, observed_at
    FROM history_l WHERE is_current""",
    "cdc_l": f"""
    SELECT n.hex || '_2024-01-31T00:00:00+00:00' AS cdc_id, n.hex, n.flight,
      CASE WHEN o.hex IS NULL THEN 'NEW' ELSE COALESCE(NULLIF(concat_ws('|',
        CASE WHEN abs(n.lat - o.lat) > 0.001 OR abs(n.lon - o.lon) > 0.001 THEN 'POSITION_CHANGE' END,
        CASE WHEN abs(n.altitude_ft - o.altitude_ft) > 50 THEN 'ALT_CHANGE' END,
        CASE WHEN abs(n.gs_knots - o.gs_knots) > 5 THEN 'SPEED_CHANGE' END,
        CASE WHEN abs(n.track_deg - o.track_deg) > 2 THEN 'HEADING_CHANGE' END), ''), 'UNCHANGED') END AS cdc_event,
      o.lat AS old_lat, n.lat AS new_lat, o.lon AS old_lon, n.lon AS new_lon,
      o.altitude_ft AS old_altitude_ft, n.altitude_ft AS new_altitude_ft,
      o.gs_knots AS old_gs_knots, n.gs_knots AS new_gs_knots,
      o.track_deg AS old_track_deg, n.track_deg AS new_track_deg, {AS_OF} AS detected_at
    FROM latest_l n LEFT JOIN latest_l1 o ON n.hex = o.hex""",
    "two": """
    SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY hex ORDER BY fetched_at DESC, ingestion_id) AS r FROM clean_n WHERE NOT is_deleted)
    WHERE r <= 2""",
    "kpi_n": """
    SELECT count(*) FILTER (WHERE NOT is_deleted) AS active_flights,
      count(DISTINCT hex) FILTER (WHERE NOT is_deleted) AS aircraft_count,
      round(avg(alt_baro) FILTER (WHERE NOT is_deleted), 0) AS avg_altitude,
      round(avg(gs) FILTER (WHERE NOT is_deleted), 1) AS avg_speed,
      count(*) FILTER (WHERE NOT is_deleted AND is_emergency) AS emergency_flights,
      count(*) FILTER (WHERE NOT is_deleted AND is_military) AS military_flights,
      count(*) FILTER (WHERE is_deleted AND deleted_reason = 'DISAPPEARED') AS disappeared_aircraft,
      round(100.0::DOUBLE * count(*) FILTER (WHERE is_deleted) / NULLIF(count(*), 0), 2) AS disappearance_rate_pct
    FROM state_n""",
    "live_n": "SELECT * FROM state_n WHERE NOT is_deleted",
    "grouped_n": """
    SELECT 'flights_by_airline' AS metric_name, 'airline_icao' AS dimension,
           COALESCE(airline_icao, 'UNKNOWN') AS dimension_value, CAST(count(*) AS DOUBLE) AS metric_value
    FROM live_n GROUP BY 3
    UNION ALL SELECT 'flights_by_type', 'aircraft_type', COALESCE(aircraft_type, 'UNKNOWN'),
           CAST(count(*) AS DOUBLE) FROM live_n GROUP BY 3
    UNION ALL SELECT 'flights_by_region', 'source_region', COALESCE(source_region, 'None'),
           CAST(count(*) AS DOUBLE) FROM live_n GROUP BY 3
    UNION ALL (SELECT 'top_operators', 'airline_icao', COALESCE(airline_icao, 'UNKNOWN') AS v,
           CAST(count(*) AS DOUBLE) AS n FROM live_n GROUP BY 3 ORDER BY n DESC, v LIMIT 10)
    UNION ALL (SELECT 'route_frequency', 'callsign', callsign AS v, CAST(count(*) AS DOUBLE) AS n
           FROM clean_n WHERE NOT is_deleted AND callsign <> 'UNKNOWN' GROUP BY 3 ORDER BY n DESC, v LIMIT 20)
    UNION ALL SELECT 'flight_density', 'grid',
           CAST(CAST(floor(lat) AS INTEGER) AS VARCHAR) || '_' || CAST(CAST(floor(lon) AS INTEGER) AS VARCHAR),
           CAST(count(*) AS DOUBLE) FROM live_n WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY 3
    UNION ALL SELECT 'flights_by_altitude_band', 'altitude_band',
           CASE WHEN alt_baro < 0 THEN 'ground_level' WHEN alt_baro < 10000 THEN '0_10k_ft'
                WHEN alt_baro < 20000 THEN '10k_20k_ft' WHEN alt_baro < 35000 THEN '20k_35k_ft'
                ELSE '35k_plus_ft' END,
           CAST(count(*) AS DOUBLE) FROM live_n WHERE alt_baro IS NOT NULL GROUP BY 3
    UNION ALL SELECT 'emergency_by_squawk', 'squawk', COALESCE(squawk, 'UNKNOWN'),
           CAST(count(*) AS DOUBLE) FROM live_n WHERE is_emergency GROUP BY 3""",
    "metrics_n": f"""
    SELECT {AS_OF} AS snapshot_at, metric_name, dimension, dimension_value, metric_value FROM grouped_n
    UNION ALL
    SELECT {AS_OF}, u.name, NULL, NULL, COALESCE(u.v, 0)
    FROM kpi_n, LATERAL (VALUES
      ('active_flights', CAST(active_flights AS DOUBLE)), ('aircraft_count', CAST(aircraft_count AS DOUBLE)),
      ('avg_altitude', avg_altitude), ('avg_speed', avg_speed),
      ('emergency_flights', CAST(emergency_flights AS DOUBLE)),
      ('military_flights', CAST(military_flights AS DOUBLE)),
      ('disappeared_aircraft', CAST(disappeared_aircraft AS DOUBLE)),
      ('disappearance_rate_pct', disappearance_rate_pct)) AS u(name, v)""",
    "routes_n": f"""
    SELECT callsign, airline_icao, aircraft_type, count(*) AS total_observations,
      round(avg(alt_baro), 0) AS avg_altitude, round(avg(gs), 1) AS avg_speed,
      min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon,
      string_agg(DISTINCT source_region, ', ' ORDER BY source_region) AS regions_seen,
      {AS_OF} AS computed_at
    FROM clean_n WHERE NOT is_deleted AND callsign <> 'UNKNOWN' GROUP BY 1, 2, 3""",
    "cells_n": f"""
    SELECT CAST(CAST(floor(lat) AS INTEGER) AS VARCHAR) || '_' || CAST(CAST(floor(lon) AS INTEGER) AS VARCHAR) AS grid_cell,
      CAST(floor(lat) AS INTEGER) AS lat_bucket, CAST(floor(lon) AS INTEGER) AS lon_bucket,
      count(*) AS flight_count, round(avg(alt_baro), 0) AS avg_altitude,
      count(*) FILTER (WHERE is_emergency) AS emergency_count,
      count(*) FILTER (WHERE is_military) AS military_count, {AS_OF} AS computed_at
    FROM live_n WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY 1, 2, 3""",
    "aircraft_l": f"""
    SELECT hex, max(registration) AS registration, max(aircraft_type) AS aircraft_type,
      max(category) AS category, min(ingested_at) AS first_seen, max(ingested_at) AS last_seen,
      count(*) AS total_observations, max(ingested_at) > {AS_OF} - INTERVAL 5 MINUTE AS is_active,
      {AS_OF} AS updated_at FROM clean_l GROUP BY hex""",
    "airline_l": f"""
    SELECT substr(flight, 1, 3) AS callsign_prefix, substr(flight, 1, 3) AS airline_name,
      count(*) AS flight_count, avg(altitude_ft) AS avg_altitude_ft, avg(gs_knots) AS avg_speed_knots,
      max(ingested_at) AS last_seen, {AS_OF} AS updated_at
    FROM clean_l WHERE length(flight) >= 3 GROUP BY 1""",
    "minutes_l": """
    SELECT date_trunc('minute', ingested_at) AS metric_time, region, count(*) AS total_flights,
      count(*) FILTER (WHERE on_ground) AS on_ground, count(*) FILTER (WHERE NOT on_ground) AS airborne,
      avg(altitude_ft) AS avg_altitude_ft, max(altitude_ft) AS max_altitude_ft,
      avg(gs_knots) AS avg_speed_knots, max(gs_knots) AS max_speed_knots,
      count(*) FILTER (WHERE is_emergency) AS emergency_count,
      count(DISTINCT hex) AS unique_aircraft, count(DISTINCT substr(flight, 1, 3)) AS unique_airlines
    FROM clean_l GROUP BY 1, 2""",
    "kpi_l": """
    SELECT count(DISTINCT hex) AS c1, round(avg(altitude_ft), 0) AS c2, round(avg(gs_knots), 0) AS c3,
      count(DISTINCT CASE WHEN is_emergency THEN hex END) AS c4, count(DISTINCT aircraft_type) AS c5,
      count(DISTINCT substr(flight, 1, 3)) AS c6,
      sum(CASE WHEN on_ground THEN 1 ELSE 0 END) AS c7,
      sum(CASE WHEN NOT on_ground THEN 1 ELSE 0 END) AS c8
    FROM current_l""",
    "kpis_l": f"""
    SELECT u.kpi_name, u.kpi_value, u.kpi_label, {AS_OF} AS computed_at FROM kpi_l, LATERAL (VALUES
      ('active_flights', CAST(c1 AS DOUBLE), 'Active Flights'),
      ('avg_altitude_ft', CAST(c2 AS DOUBLE), 'Avg Altitude (ft)'),
      ('avg_speed_knots', CAST(c3 AS DOUBLE), 'Avg Speed (knots)'),
      ('emergency_count', CAST(c4 AS DOUBLE), 'Emergency Squawks'),
      ('unique_types', CAST(c5 AS DOUBLE), 'Aircraft Types'),
      ('unique_airlines', CAST(c6 AS DOUBLE), 'Airlines'),
      ('on_ground', CAST(c7 AS DOUBLE), 'On Ground'),
      ('airborne', CAST(c8 AS DOUBLE), 'Airborne')) AS u(kpi_name, kpi_value, kpi_label)""",
    "type_rank": """
    SELECT region, aircraft_type, row_number() OVER (
        PARTITION BY region ORDER BY count(*) DESC, aircraft_type) AS r
    FROM clean_l WHERE aircraft_type IS NOT NULL GROUP BY region, aircraft_type""",
    "regions_l": f"""
    SELECT c.region, c.region_label, count(*) AS total_flights, count(*) AS active_now,
      avg(c.altitude_ft) AS avg_altitude_ft, avg(c.gs_knots) AS avg_speed_knots,
      count(*) FILTER (WHERE c.is_emergency) AS emergency_count,
      max(t.aircraft_type) AS top_aircraft_type, {AS_OF} AS computed_at
    FROM current_l c LEFT JOIN type_rank t ON t.region = c.region AND t.r = 1 GROUP BY 1, 2""",
    "operators_l": f"""
    SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, substr(flight, 1, 3)) AS INTEGER) AS rank,
      substr(flight, 1, 3) AS operator, count(*) AS flight_count,
      avg(altitude_ft) AS avg_altitude_ft, avg(gs_knots) AS avg_speed_knots, {AS_OF} AS computed_at
    FROM clean_l WHERE length(flight) >= 3 GROUP BY substr(flight, 1, 3) ORDER BY 1 LIMIT 20""",
    "trend_l": """
    SELECT date_trunc('hour', ingested_at) AS hour_bucket, region, count(DISTINCT hex) AS flight_count,
      avg(altitude_ft) AS avg_altitude_ft, avg(gs_knots) AS avg_speed_knots,
      count(*) FILTER (WHERE is_emergency) AS emergency_count
    FROM clean_l GROUP BY 1, 2""",
}

_WITH = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _CTES.items())


def _cdc(pairs: str, at: str, heading: str) -> str:
    """Change events from (current c, previous p) pairs."""
    return f"""
    SELECT c.hex, c.callsign, 'NEW' AS change_type, CAST(NULL AS VARCHAR) AS old_value,
      'lat=' || c.lat || ',lon=' || c.lon AS new_value, c.fetched_at AS event_at, {at} AS detected_at
    FROM {pairs} WHERE p.hex IS NULL
    UNION ALL SELECT c.hex, c.callsign, 'POSITION', p.lat || ',' || p.lon, c.lat || ',' || c.lon,
      c.fetched_at, {at} FROM {pairs} WHERE abs(c.lat - p.lat) > 0.001 OR abs(c.lon - p.lon) > 0.001
    UNION ALL SELECT c.hex, c.callsign, 'ALTITUDE', CAST(p.alt_baro AS VARCHAR), CAST(c.alt_baro AS VARCHAR),
      c.fetched_at, {at} FROM {pairs}
      WHERE p.hex IS NOT NULL AND abs(COALESCE(c.alt_baro, 0) - COALESCE(p.alt_baro, 0)) > 100
    UNION ALL SELECT c.hex, c.callsign, 'SPEED', CAST(p.gs AS VARCHAR), CAST(c.gs AS VARCHAR),
      c.fetched_at, {at} FROM {pairs}
      WHERE p.hex IS NOT NULL AND abs(COALESCE(c.gs, 0) - COALESCE(p.gs, 0)) > 10
    UNION ALL SELECT c.hex, c.callsign, 'HEADING', CAST(p.track AS VARCHAR), CAST(c.track AS VARCHAR),
      c.fetched_at, {at} FROM {pairs} WHERE p.hex IS NOT NULL AND {heading} > 5"""


_PAIRS = "(SELECT * FROM two WHERE r = 1) c LEFT JOIN (SELECT * FROM two WHERE r = 2) p ON c.hex = p.hex"
_PAIRS_SINCE = (
    "(SELECT * FROM two WHERE r = 1 AND fetched_at > (SELECT max(fetched_at) FROM clean_n1 "
    "WHERE NOT is_deleted)) c LEFT JOIN (SELECT * FROM two WHERE r = 2) p ON c.hex = p.hex"
)
_PLAIN_HEADING = "abs(COALESCE(c.track, 0) - COALESCE(p.track, 0))"
_WRAPPED_HEADING = (
    "least(abs(COALESCE(c.track, 0) - COALESCE(p.track, 0)), "
    "360 - abs(COALESCE(c.track, 0) - COALESCE(p.track, 0)))"
)

# Clean rows of the stored layer: batch 0 rows of vanished keys are marked at the
# split, live rows of keys vanished in batch 1 at the end.
_LAKE_CLEAN = f"""
    SELECT hex, is_deleted OR gone AS is_deleted,
      CASE WHEN gone AND NOT is_deleted THEN 'DISAPPEARED' ELSE deleted_reason END AS deleted_reason,
      count(*) AS rows,
      max(CASE WHEN gone AND NOT is_deleted THEN gone_at WHEN is_deleted THEN loaded END) AS deleted_at
    FROM (
      SELECT c.hex, c.is_deleted, c.deleted_reason,
        CASE WHEN c.fetched_at < {SPLIT} THEN {SPLIT} ELSE {AS_OF} END AS loaded,
        (c.fetched_at < {SPLIT} AND g1.hex IS NOT NULL) OR g2.hex IS NOT NULL AS gone,
        CASE WHEN c.fetched_at < {SPLIT} AND g1.hex IS NOT NULL THEN {SPLIT} ELSE {AS_OF} END AS gone_at
      FROM clean_n c LEFT JOIN gone_1 g1 ON c.hex = g1.hex LEFT JOIN gone_2 g2 ON c.hex = g2.hex)
    GROUP BY 1, 2, 3"""

# Versions of the stored layer follow the live keys of each batch.
_LAKE_HISTORY = f"""
    SELECT a.hex, {_prefixed('a', _HIST_N)}, {SPLIT} AS effective_from,
      CASE WHEN b.hex IS NOT NULL AND {_DIFFERS} THEN {AS_OF} END AS effective_to,
      NOT (b.hex IS NOT NULL AND {_DIFFERS}) AS is_current, FALSE AS is_deleted,
      CAST(NULL AS TIMESTAMP) AS deleted_at, CAST(NULL AS VARCHAR) AS deleted_reason
    FROM (SELECT * FROM state_1 WHERE NOT is_deleted) a
    LEFT JOIN (SELECT * FROM state_2 WHERE NOT is_deleted) b ON a.hex = b.hex
    UNION ALL
    SELECT b.hex, {_prefixed('b', _HIST_N)}, {AS_OF}, NULL, TRUE, FALSE, NULL, NULL
    FROM (SELECT * FROM state_2 WHERE NOT is_deleted) b
    LEFT JOIN (SELECT * FROM state_1 WHERE NOT is_deleted) a ON a.hex = b.hex
    WHERE a.hex IS NULL OR {_DIFFERS}"""

_LAKE_TWO_1 = """(SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY hex ORDER BY fetched_at DESC, ingestion_id) AS r FROM clean_n1 WHERE NOT is_deleted) WHERE r = %d)"""
_LAKE_TWO_2 = """(SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY hex ORDER BY fetched_at DESC, ingestion_id) AS r FROM clean_n
    WHERE NOT is_deleted AND NOT (fetched_at < TIMESTAMP '2024-01-16' AND hex IN (SELECT hex FROM gone_1)))
    WHERE r = %d)"""
_LAKE_EVENTS = f"""
    SELECT change_type, count(*) AS count FROM (
      SELECT change_type FROM ({_cdc(f"{_LAKE_TWO_1 % 1} c LEFT JOIN {_LAKE_TWO_1 % 2} p ON c.hex = p.hex", SPLIT, _PLAIN_HEADING)})
      UNION ALL
      SELECT change_type FROM ({_cdc(f"(SELECT * FROM {_LAKE_TWO_2 % 1} WHERE fetched_at >= {SPLIT}) c LEFT JOIN {_LAKE_TWO_2 % 2} p ON c.hex = p.hex", AS_OF, _PLAIN_HEADING)})
      UNION ALL SELECT 'DISAPPEARED' FROM gone_1
      UNION ALL SELECT 'DISAPPEARED' FROM gone_2
      UNION ALL SELECT 'NEW' FROM returned)
    GROUP BY 1"""

# Live rows of the stored layer after both batches.
_LAKE_LIVE = f"""(SELECT * FROM clean_n WHERE NOT is_deleted AND hex NOT IN (SELECT hex FROM gone_2)
    AND NOT (fetched_at < {SPLIT} AND hex IN (SELECT hex FROM gone_1)))"""


def _vanish_events(gone: str, at: str) -> str:
    return f"""
    SELECT hex, callsign, strftime(last_seen_at, '%Y-%m-%d %H:%M:%S') AS old_value, last_seen_at AS event_at,
      {at} AS detected_at FROM {gone}"""


# One measure per row of every mart: key columns, and the sum of some measures.
_MEASURED = {
    "aircraft_dim": ("aircraft_l", "hex first_seen last_seen", "total_observations"),
    "airline_dim": ("airline_l", "callsign_prefix last_seen", "flight_count avg_altitude_ft"),
    "minute_metrics": ("minutes_l", "metric_time region", "total_flights on_ground airborne unique_aircraft unique_airlines"),
    "kpis": ("kpis_l", "kpi_name kpi_label", "kpi_value"),
    "region_summary": ("regions_l", "region top_aircraft_type", "total_flights emergency_count"),
    "top_operators": ("operators_l", "operator rank", "flight_count"),
    "hourly_trend": ("trend_l", "hour_bucket region", "flight_count emergency_count"),
}

_FEED_COLS = "callsign, lat, lon, last_seen_at, is_deleted"
_SAME = " AND ".join(
    f"o.{c.strip()} IS NOT DISTINCT FROM n.{c.strip()}"
    for c in f"{_ATTR_N}, last_seen_at, is_deleted, deleted_at, deleted_reason, _updated_at".split(",")
)
_AFTER_FEED = f"(SELECT * FROM ({_merge('state_1', 'latest_n2', AS_OF)}) WHERE NOT is_deleted)"

_FEED = f"""
    SELECT o.hex, {_prefixed('o', _FEED_COLS)},
      CASE WHEN n.hex IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type
    FROM state_1 o LEFT JOIN {_AFTER_FEED} n ON o.hex = n.hex WHERE n.hex IS NULL OR NOT ({_SAME})
    UNION ALL
    SELECT n.hex, {_prefixed('n', _FEED_COLS)},
      CASE WHEN o.hex IS NULL THEN 'insert' ELSE 'update_postimage' END
    FROM {_AFTER_FEED} n LEFT JOIN state_1 o ON o.hex = n.hex WHERE o.hex IS NULL OR NOT ({_SAME})"""

_PRESENCE = """
    SELECT hex, min(ingested_at) AS seen_from, max(ingested_at) AS seen_to, count(*) AS observations FROM (
      SELECT hex, ingested_at, sum(opens) OVER (PARTITION BY hex ORDER BY ingested_at ROWS UNBOUNDED PRECEDING) AS island FROM (
        SELECT hex, ingested_at, CASE WHEN ingested_at - lag(ingested_at) OVER (PARTITION BY hex ORDER BY ingested_at)
          <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS opens FROM clean_l))
    GROUP BY hex, island"""

_DOCS = "SELECT *, min(date_trunc('second', event_ts)) OVER (PARTITION BY region, event_id // 200) AS polled FROM base"

_LIVE_ROWS = """(SELECT *, row_number() OVER (PARTITION BY hex ORDER BY fetched_at, ingestion_id DESC) AS i
    FROM clean_n WHERE NOT is_deleted)"""
_EVERY_PAIR = f"{_LIVE_ROWS} c LEFT JOIN {_LIVE_ROWS} p ON c.hex = p.hex AND p.i = c.i - 1"

# Islands: rows whose tracked columns differ from the row before, and the next such row.
_VERSIONS = f"""
    SELECT *, row_number() OVER k AS version, lead(fetched_at) OVER k AS effective_to FROM (
      SELECT c.hex, {_prefixed('c', _HIST_N)}, c.fetched_at, p.hex IS NULL AS opens,
        concat_ws(',', {", ".join(f"CASE WHEN c.{n} IS DISTINCT FROM p.{n} THEN '{n}' END" for n in _TRACK_N)}) AS cols
      FROM {_EVERY_PAIR}) WHERE opens OR cols <> '' WINDOW k AS (PARTITION BY hex ORDER BY fetched_at)"""

_QUERIES = {
    "ingest_snapshots": r"""
    SELECT region AS source_region, polled AS fetched_at, hex, trim(flight) AS flight, lat, lon,
      CASE WHEN regexp_full_match(alt_text, '-?\d+') THEN CAST(alt_text AS INTEGER) END AS alt_baro,
      gs, track, baro_rate, squawk, emergency, registration, aircraft_type, category, seen, db_flags
    FROM (""" + _DOCS + ")",
    "ingest_enriched": f"""
    SELECT hex, NULLIF(trim(flight), '') AS flight, registration, aircraft_type, squawk, category, lat,
      lon, alt_text AS alt_baro, gs, track, CAST(baro_rate AS DOUBLE) AS baro_rate, seen,
      NULLIF(emergency, '') AS emergency, region AS _region,
      upper(region[1]) || substr(region, 2) AS _region_label, {AS_OF} AS _ingested_at,
      'feed://v2/lat/' || CASE region WHEN 'delhi' THEN '28.61/lon/77.2' WHEN 'mumbai' THEN '19.08/lon/72.88'
        WHEN 'hyderabad' THEN '17.38/lon/78.48' ELSE '12.97/lon/77.59' END || '/dist/250' AS _source_url
    FROM base""",
    "ingest_audit": f"""
    SELECT region, 'OK' AS status, count(*) AS records_loaded, {AS_OF} AS loaded_at FROM base GROUP BY 1""",
    "ingest_new_rounds": f"""
    SELECT CAST(polled >= {SPLIT} AS BIGINT) AS epoch, region, 'OK' AS status, count(*) AS records_loaded,
      CAST(0 AS BIGINT) AS failed, count(*) AS raw_rows FROM ({_DOCS}) GROUP BY 1, 2
    UNION ALL SELECT 1, 'delhi', 'ERROR', 0, 1, 0""",
    "empty_documents": """
    SELECT region, count(DISTINCT event_id // 200) + 2 AS documents, CAST(2 AS BIGINT) AS empty, count(*) AS raw_rows
    FROM base GROUP BY 1""",
    "table_cycle": """
    SELECT u.step, u.tables, u.rows FROM (SELECT (SELECT count(*) FROM clean_n) AS a, (SELECT count(*) FROM clean_n1) AS b) n,
      LATERAL (VALUES ('created', CAST(8 AS BIGINT), CAST(0 AS BIGINT)), ('filled', 8, n.a), ('overwritten', 8, n.b),
        ('emptied', 8, 0), ('not confirmed', 8, 0), ('dropped', 0, 0)) AS u(step, tables, rows)""",
    "raw_landing": f"""
    SELECT {AS_OF} AS ingestion_time, count(DISTINCT region || '/' || (event_id // 200)) AS documents,
      count(*) AS elements FROM base""",
    "region_lookup": """
    SELECT r.source_region, r.row_count, v.centre_lat, v.centre_lon, CAST(250 AS INTEGER) AS radius_nm,
      upper(r.source_region[1]) || substr(r.source_region, 2) AS label
    FROM (SELECT source_region, count(*) AS row_count FROM raw_n GROUP BY 1) r
    LEFT JOIN (VALUES ('hyderabad', 17.38::DOUBLE, 78.48::DOUBLE), ('delhi', 28.61, 77.2),
      ('mumbai', 19.08, 72.88), ('bangalore', 12.97, 77.59)) AS v(region, centre_lat, centre_lon)
    ON v.region = r.source_region""",
    "clean_n": "SELECT * FROM clean_n",
    "clean_l": "SELECT * FROM clean_l",
    "incremental_clean": "SELECT * FROM clean_n WHERE fetched_at > (SELECT max(fetched_at) FROM clean_n1)",
    "dedup_rank": "SELECT ingestion_id, hex, fetched_at, rn > 1 AS is_duplicate FROM ranked",
    "dq_flags": """
    SELECT dq_missing_pos, dq_missing_call, dq_bad_alt, dq_bad_speed, count(*) AS rows
    FROM clean_l GROUP BY 1, 2, 3, 4""",
    "new_keys": """
    SELECT hex, flight, ingested_at, region FROM clean_l
    WHERE hex NOT IN (SELECT hex FROM clean_l WHERE region = 'delhi' AND on_ground)""",
    "quarantine": """
    SELECT CASE WHEN emergency = 'general' THEN 'corrupt' ELSE 'usable' END AS kind, source_region,
      count(*) AS rows FROM raw_n GROUP BY 1, 2""",
    "load_stats": """
    SELECT count(*) AS total, count(*) FILTER (WHERE NOT is_deleted) AS active,
      count(*) FILTER (WHERE deleted_reason = 'INVALID_COORDS') AS invalid_coords,
      count(*) FILTER (WHERE deleted_reason = 'DUPLICATE') AS duplicates,
      count(*) FILTER (WHERE is_deleted) AS soft_deleted FROM clean_n""",
    "latest_per_key": "SELECT * FROM latest_n",
    "latest_per_key_l": "SELECT * FROM latest_l",
    "latest_two": "SELECT hex, fetched_at, callsign, CAST(r AS INTEGER) AS rn FROM two",
    "merge_current": _merge("state_1", "latest_n2", AS_OF),
    "change_feed": _FEED,
    "change_feed_digest": _FEED,
    "soft_delete_state": _set_state(
        "state_n", "(SELECT hex FROM state_n WHERE is_emergency)", "TRUE", "'MANUAL'", AS_OF
    ),
    "soft_delete_history": f"""
    SELECT hex, {_HIST_N}, effective_from,
      CASE WHEN hit THEN {AS_OF} ELSE effective_to END AS effective_to, is_current AND NOT hit AS is_current,
      is_deleted OR hit AS is_deleted, CASE WHEN hit THEN {AS_OF} ELSE deleted_at END AS deleted_at,
      CASE WHEN hit THEN 'MANUAL' ELSE deleted_reason END AS deleted_reason
    FROM (SELECT *, is_current AND hex IN (SELECT hex FROM state_n WHERE is_emergency) AS hit FROM history_n)""",
    "restore_state": _set_state(
        "state_n", "(SELECT hex FROM state_n WHERE is_emergency)", "FALSE", "NULL", AS_OF
    ),
    "soft_deleted": """
    SELECT hex, callsign, last_seen_at, deleted_at, deleted_reason FROM state_n WHERE is_deleted""",
    "disappeared_state": "SELECT * FROM state_n",
    "disappeared_clean": f"""
    SELECT hex, is_deleted, deleted_reason, count(*) AS rows, max(deleted_at) AS deleted_at FROM (
      SELECT c.hex, c.is_deleted OR g.hex IS NOT NULL AS is_deleted,
        CASE WHEN c.is_deleted THEN c.deleted_reason WHEN g.hex IS NOT NULL THEN 'DISAPPEARED' END AS deleted_reason,
        CASE WHEN c.is_deleted OR g.hex IS NOT NULL THEN {AS_OF} END AS deleted_at
      FROM clean_n c LEFT JOIN gone_n g ON c.hex = g.hex) GROUP BY 1, 2, 3""",
    "disappeared_events": "SELECT * FROM events_n",
    "event_suppression": """
    SELECT * FROM events_n WHERE hex NOT IN (SELECT hex FROM state_n WHERE is_emergency)""",
    "reactivated_state": "SELECT * FROM woken",
    "reactivated_events": f"""
    SELECT hex, callsign, 'NEW' AS change_type, 'DISAPPEARED' AS old_value, 'REACTIVATED' AS new_value,
      (SELECT max(fetched_at) FROM raw_n2) AS event_at, {AS_OF} AS detected_at FROM returned""",
    "disappearance_rate": f"""
    SELECT *, COALESCE(round(100.0::DOUBLE * disappeared_in_window / NULLIF(active_now + disappeared_in_window, 0), 2), 0)
        AS disappearance_rate FROM (
      SELECT count(*) FILTER (WHERE NOT is_deleted) AS active_now,
        count(*) FILTER (WHERE is_deleted AND deleted_reason = 'DISAPPEARED' AND deleted_at >= {AS_OF} - {WINDOW})
          AS disappeared_in_window,
        count(*) FILTER (WHERE deleted_reason = 'INVALID_COORDS') AS invalid_coords_total,
        count(*) FILTER (WHERE deleted_reason = 'DUPLICATE') AS duplicates_total FROM state_2)""",
    "disappearance_by_minute": f"""
    SELECT minute_bucket, n AS disappeared_count, a AS total_active,
      round(100.0::DOUBLE * n / NULLIF(a, 0), 2) AS rate_pct
    FROM (SELECT date_trunc('minute', last_seen_at) AS minute_bucket, count(DISTINCT hex) AS n FROM gone_n
          WHERE last_seen_at >= {AS_OF} - {WINDOW} GROUP BY 1),
         (SELECT count(*) AS a FROM live_n)
    ORDER BY 1 DESC LIMIT 20""",
    "disappeared_since": f"""
    SELECT count(DISTINCT hex) AS disappeared_aircraft FROM state_2
    WHERE is_deleted AND deleted_reason = 'DISAPPEARED' AND deleted_at >= {AS_OF} - INTERVAL 60 MINUTE""",
    "vanished_at_once": """
    SELECT hex, callsign, last_seen_at FROM merged_n WHERE last_seen_at < (SELECT max(fetched_at) FROM raw_n)
      AND hex NOT IN (SELECT hex FROM raw_n WHERE fetched_at = (SELECT max(fetched_at) FROM raw_n))""",
    "cdc_long": _cdc(_PAIRS, AS_OF, _PLAIN_HEADING),
    "cdc_since": _cdc(_PAIRS_SINCE, AS_OF, _WRAPPED_HEADING),
    "cdc_wide": "SELECT * FROM cdc_l",
    "scd2_n": "SELECT * FROM history_n",
    "scd2_not_null_safe": _history_n(_DIFFERS_PLAIN),
    "scd2_l": "SELECT * FROM history_l",
    "scd2_from_log": f"""
    SELECT hex, {_HIST_N}, fetched_at AS effective_from, effective_to, effective_to IS NULL AS is_current, version,
      CASE WHEN opens THEN 'INITIAL_LOAD' ELSE 'CHANGED:' || cols END AS change_reason FROM ({_VERSIONS})""",
    "scd2_from_batches": f"""
    SELECT hex, {_HIST_N}, fetched_at AS effective_from, effective_to, effective_to IS NULL AS is_current
    FROM ({_VERSIONS})""",
    "cdc_from_log": _cdc(_EVERY_PAIR, AS_OF, _PLAIN_HEADING),
    "current_from_history": "SELECT * FROM current_l",
    "lake_current": "SELECT * FROM state_2",
    "lake_mixed_profiles": "SELECT * FROM state_2",
    "lake_gold_after_gap": "SELECT * FROM airline_l",
    "lake_late_rows": " UNION ALL ".join(
        f"""SELECT '{late}' AS late, (SELECT count(*) FROM raw_n WHERE fetched_at < {SPLIT}) AS late_rows,
        (SELECT count(*) FROM clean_n2) + {kept} AS clean_rows, {aside} AS quarantined"""
        for late, kept, aside in (
            ("drop", "0", "CAST(0 AS BIGINT)"),
            ("keep", "(SELECT count(*) FROM clean_n1)", "CAST(0 AS BIGINT)"),
            ("quarantine", "0", f"(SELECT count(*) FROM raw_n WHERE fetched_at < {SPLIT})"),
        )
    ),
    "lake_gold_after_crash": " UNION ALL ".join(
        f"""SELECT '{mart}' AS mart, concat_ws('|', {", ".join(f"CAST({k} AS VARCHAR)" for k in keys.split())}) AS key,
        {" + ".join(f"COALESCE(CAST({m} AS DOUBLE), 0)" for m in measures.split())} AS value FROM {table}"""
        for mart, (table, keys, measures) in _MEASURED.items()
    ),
    "bucketed_current": f"""
    SELECT hex, {_ATTR_N}, last_seen_at, FALSE AS is_deleted, CAST(NULL AS TIMESTAMP) AS deleted_at,
      CAST(NULL AS VARCHAR) AS deleted_reason, TIMESTAMP '2024-01-01' + INTERVAL 36 HOUR * CAST(
        1 + date_diff('hour', TIMESTAMP '2024-01-01', last_seen_at) // 36 AS INTEGER) AS _updated_at
    FROM latest_n""",
    "event_suppression_stored": f"""
    {_vanish_events('gone_1', SPLIT)} UNION ALL
    {_vanish_events('(SELECT * FROM gone_2 WHERE hex NOT IN (SELECT hex FROM gone_1))', AS_OF)}""",
    "lake_clean": _LAKE_CLEAN,
    "lake_history": _LAKE_HISTORY,
    "lake_events": _LAKE_EVENTS,
    "lake_local_history": "SELECT hex, effective_from, effective_to, is_current, change_reason FROM history_l",
    "commit_history": f"""
    SELECT CAST(0 AS BIGINT) AS version, {SPLIT} AS committed_at, 'BATCH' AS operation, count(*) AS total,
      count(*) FILTER (WHERE deleted_reason = 'DUPLICATE') AS duplicates FROM clean_n1
    UNION ALL SELECT 1, {AS_OF}, 'BATCH', count(*), count(*) FILTER (WHERE deleted_reason = 'DUPLICATE') FROM clean_n2""",
    "layer_profile": """
    SELECT 'raw' AS table_name, count(*) AS row_count FROM raw_n
    UNION ALL SELECT 'clean', count(*) FROM clean_n UNION ALL SELECT 'current', count(*) FROM state_n
    UNION ALL SELECT 'history', count(*) FROM history_n""",
    "stream_minute_metrics": "SELECT * FROM minutes_l",
    "stream_hourly_trend": "SELECT * FROM trend_l",
    "stream_dedup": "SELECT DISTINCT hex, fetched_at FROM raw_n",
    "stream_silver": "SELECT * FROM state_2",
    "stream_dedup_best": "SELECT hex, fetched_at, ingestion_id, seen, lat, gs FROM ranked WHERE rn = 1",
    "stream_late_rows": """
    SELECT epoch, on_time_rows, late_rows, on_time_rows AS on_time_stored, late_rows AS late_stored FROM (
      SELECT CAST(0 AS BIGINT) AS epoch, count(*) AS on_time_rows, CAST(0 AS BIGINT) AS late_rows FROM raw_n2
      UNION ALL
      SELECT 1, count(*) FILTER (WHERE NOT late), count(*) FILTER (WHERE late) FROM (
        SELECT fetched_at < (SELECT max(fetched_at) FROM raw_n2) - INTERVAL 20 DAY AS late FROM raw_n1))""",
    "presence_intervals": _PRESENCE,
    "stream_presence": _PRESENCE,
    "kpi_scalar": "SELECT * FROM kpi_n",
    "kpi_grouped": "SELECT * FROM grouped_n",
    "kpi_snapshot": "SELECT * FROM metrics_n",
    "route_frequency": "SELECT * FROM grouped_n WHERE metric_name = 'route_frequency'",
    "route_summary": "SELECT * FROM routes_n",
    "hotspots": "SELECT * FROM cells_n",
    "aircraft_dim": "SELECT * FROM aircraft_l",
    "airline_dim": "SELECT * FROM airline_l",
    "minute_metrics": "SELECT * FROM minutes_l",
    "kpis_unpivot": "SELECT * FROM kpis_l",
    "region_summary": "SELECT * FROM regions_l",
    "top_operators": "SELECT * FROM operators_l",
    "hourly_trend": "SELECT * FROM trend_l",
    "updated_aircraft": "SELECT * FROM aircraft_l",
    "updated_airlines": "SELECT * FROM airline_l",
    "updated_regions": "SELECT * FROM regions_l",
    "updated_minutes": "SELECT * FROM minutes_l",
    "updated_hours": "SELECT * FROM trend_l",
    "bitmap_minutes": "SELECT * FROM minutes_l",
    "bitmap_hours": "SELECT * FROM trend_l",
    "updated_routes": f"""
    SELECT callsign, airline_icao, aircraft_type, count(*) AS total_observations,
      round(avg(alt_baro), 0) AS avg_altitude, round(avg(gs), 1) AS avg_speed,
      min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon,
      string_agg(DISTINCT source_region, ', ' ORDER BY source_region) AS regions_seen,
      {AS_OF} AS computed_at
    FROM {_LAKE_LIVE} WHERE callsign <> 'UNKNOWN' GROUP BY 1, 2, 3""",
    "updated_route_frequency": f"""
    SELECT 'route_frequency' AS metric_name, 'callsign' AS dimension, callsign AS dimension_value,
      CAST(count(*) AS DOUBLE) AS metric_value
    FROM {_LAKE_LIVE} WHERE callsign <> 'UNKNOWN' GROUP BY 3 ORDER BY 4 DESC, 3 LIMIT 20""",
    "live_flights": f"""
    SELECT hex, {_ATTR_L}, last_seen, updated_at FROM current_l WHERE region = 'delhi' AND NOT on_ground
""",
    "live_emergencies": f"""
    SELECT hex, {_ATTR_L}, last_seen, updated_at FROM current_l WHERE is_emergency
""",
    "page_clean": """
    SELECT * FROM clean_l WHERE region = 'mumbai' ORDER BY ingested_at DESC, hex LIMIT 100 OFFSET 50""",
    "page_after": """
    SELECT * FROM clean_l WHERE region = 'mumbai' ORDER BY ingested_at DESC, hex LIMIT 50 OFFSET 100""",
    "key_history": "SELECT *, count(*) OVER () AS version_count FROM history_l WHERE hex = 'h7'",
    "aircraft": "SELECT * FROM aircraft_l",
    "airlines": "SELECT * FROM airline_l",
    "metrics_window": f"""
    SELECT * FROM minutes_l WHERE region = 'delhi' AND metric_time >= {AS_OF} - {HOURS}""",
    "kpi_list": "SELECT * FROM kpis_l",
    "kpi_value": "SELECT round(kpi_value, 0) AS kpi_value FROM kpis_l WHERE kpi_name = 'avg_altitude_ft'",
    "alerts": """
    SELECT hex, flight, registration, aircraft_type, squawk, lat, lon, altitude_ft, gs_knots, emergency,
      region, region_label, last_seen FROM current_l WHERE is_emergency""",
    "cdc_like": "SELECT * FROM cdc_l WHERE cdc_event LIKE '%ALT%'",
    "regions": "SELECT * FROM regions_l",
    "region_shares": "SELECT region_label AS region, total_flights FROM regions_l",
    "operators": "SELECT operator, flight_count FROM operators_l WHERE rank <= 10",
    "trend_window": f"SELECT * FROM trend_l WHERE hour_bucket >= {AS_OF} - {HOURS}",
    "geojson": """
    SELECT hex, CAST(json_object('type', 'Feature',
      'geometry', json_object('type', 'Point', 'coordinates', json_array(lon, lat)),
      'properties', json_object('hex', hex, 'flight', flight, 'registration', registration,
        'aircraft_type', aircraft_type, 'altitude_ft', altitude_ft, 'gs_knots', gs_knots,
        'track_deg', track_deg, 'on_ground', on_ground, 'is_emergency', is_emergency,
        'emergency', emergency, 'region', region)) AS VARCHAR) AS feature
    FROM current_l WHERE lat IS NOT NULL AND lon IS NOT NULL""",
    "feature_count": """
    SELECT 'FeatureCollection' AS type, count(*) AS count FROM current_l
    WHERE lat IS NOT NULL AND lon IS NOT NULL""",
    "trend_counts": "SELECT hour_bucket AS time, flight_count, region FROM trend_l",
    "trend_averages": "SELECT hour_bucket AS time, region, avg_altitude_ft, avg_speed_knots FROM trend_l",
    "live_table": """
    SELECT hex, flight, registration, aircraft_type, round(lat, 4) AS lat, round(lon, 4) AS lon,
      altitude_ft, round(gs_knots, 0) AS speed_kts, track_deg, on_ground, emergency, region
    FROM current_l""",
    "measures": """
    SELECT count(*) AS active_flights, avg(altitude_ft) AS avg_altitude_ft, avg(gs_knots) AS avg_speed_knots,
      count(*) FILTER (WHERE is_emergency) AS emergency_count,
      count(*) FILTER (WHERE NOT on_ground) AS airborne_count,
      count(*) FILTER (WHERE on_ground) AS on_ground_count,
      count(DISTINCT aircraft_type) + CAST(bool_or(aircraft_type IS NULL) AS BIGINT) AS unique_aircraft_types,
      count(DISTINCT flight) + CAST(bool_or(flight IS NULL) AS BIGINT) AS unique_airlines,
      CAST(count(*) FILTER (WHERE is_emergency) AS DOUBLE) / count(*) * 100 AS emergency_rate_pct
    FROM current_l""",
    "type_distribution": "SELECT aircraft_type, count(hex) AS count FROM current_l GROUP BY 1",
    "top_callsigns": """
    SELECT flight, flights FROM (
      SELECT flight, count(hex) AS flights, rank() OVER (ORDER BY count(hex) DESC) AS r
      FROM current_l GROUP BY 1) WHERE r <= 10""",
    "total_hourly_flights": "SELECT CAST(sum(flight_count) AS BIGINT) AS hourly_flight_count FROM trend_l",
    "growth_day_over_day": """
    SELECT t.day, t.flights, y.flights AS flights_before,
      COALESCE(CAST(t.flights - y.flights AS DOUBLE) / y.flights, 0) * 100 AS growth_pct
    FROM (SELECT CAST(hour_bucket AS DATE) AS day, max(flight_count) AS flights FROM trend_l GROUP BY 1) t
    LEFT JOIN (SELECT CAST(hour_bucket AS DATE) + 1 AS day, max(flight_count) AS flights FROM trend_l GROUP BY 1) y
    ON t.day = y.day""",
    "squawk_distribution": "SELECT squawk, count(*) AS count FROM current_l GROUP BY 1",
    "emergencies_by_hour": """
    SELECT hour_bucket, CAST(sum(emergency_count) AS BIGINT) AS emergency_count FROM trend_l GROUP BY 1""",
    "event_counts": "SELECT cdc_event, count(*) AS count FROM cdc_l GROUP BY 1",
    "typed_trend": "SELECT * FROM trend_l",
    "row_count": "SELECT count(*) AS total FROM raw_n",
    "region_profile": """
    SELECT source_region, count(*) AS row_count, count(DISTINCT hex) AS aircraft,
      min(fetched_at) AS earliest, max(fetched_at) AS latest FROM raw_n GROUP BY 1""",
    "null_profile": """
    SELECT count(*) AS total, count(*) FILTER (WHERE hex IS NULL) AS null_hex,
      count(*) FILTER (WHERE lat IS NULL) AS null_lat, count(*) FILTER (WHERE lon IS NULL) AS null_lon,
      count(*) FILTER (WHERE alt_baro IS NULL) AS null_alt_baro FROM raw_n""",
    "newest_rows": """
    SELECT ingestion_id, fetched_at, source_region, hex, flight, lat, lon, alt_baro, gs, registration,
      aircraft_type, category FROM raw_n ORDER BY fetched_at DESC, ingestion_id LIMIT 10""",
    "time_range": "SELECT min(fetched_at) AS earliest, max(fetched_at) AS latest FROM clean_n",
    "deletion_counts": """
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE NOT is_deleted) AS active,
      count(*) FILTER (WHERE is_deleted) AS soft_deleted FROM clean_n""",
    "reason_counts": """
    SELECT COALESCE(deleted_reason, 'ACTIVE') AS reason, count(*) AS count FROM clean_n GROUP BY 1""",
    "state_by_region": """
    SELECT source_region, count(*) FILTER (WHERE NOT is_deleted) AS active,
      count(*) FILTER (WHERE is_deleted) AS disappeared, count(*) FILTER (WHERE is_emergency) AS emergencies
    FROM state_n GROUP BY 1""",
    "versions_by_state": "SELECT is_current, count(*) AS count FROM history_n GROUP BY 1",
    "newest_active": """
    SELECT hex, callsign, lat, lon, alt_baro, gs, source_region, last_seen_at FROM live_n
    ORDER BY last_seen_at DESC, hex LIMIT 10""",
    "latest_scalars": "SELECT metric_name, metric_value FROM metrics_n WHERE dimension IS NULL",
    "busiest_routes": """
    SELECT callsign, airline_icao, aircraft_type, total_observations, avg_altitude, avg_speed, regions_seen
    FROM routes_n ORDER BY total_observations DESC, callsign, airline_icao NULLS FIRST, aircraft_type NULLS FIRST LIMIT 10""",
    "busiest_cells": """
    SELECT grid_cell, lat_bucket, lon_bucket, flight_count, avg_altitude, emergency_count, military_count
    FROM cells_n ORDER BY flight_count DESC, lat_bucket, lon_bucket LIMIT 10""",
    "snapshot_history": f"""
    SELECT {AS_OF} AS snapshot_min, count(DISTINCT metric_name) AS metrics FROM metrics_n""",
    "missing_required": """
    SELECT count(*) FILTER (WHERE hex IS NULL) AS null_hex,
      count(*) FILTER (WHERE fetched_at IS NULL) AS null_fetched_at FROM clean_n""",
}

ORACLE_SQL = {name: f"{_WITH}\n{body}" for name, body in _QUERIES.items()}
