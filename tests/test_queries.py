from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import duckdb
import pytest
from conftest import NOW, T0, frame

import __spark_entry__ as entry
from check import TABLES, normal
from contrail import schemas
from contrail.plans import kpis, marts, quality, serving

SF = "/root/testdata/sf0.001"
FEW = (
    "clean_n clean_l merge_current disappeared_state cdc_long cdc_wide scd2_n scd2_l kpi_snapshot "
    "route_summary hotspots minute_metrics region_summary top_operators top_callsigns"
).split()
NAMES = sorted(entry.oracle_sql()) if os.environ.get("CONTRAIL_ALL") else FEW


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_against_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(result.fetchall(), columns)


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture
def fleet(spark):
    base = {"last_seen": T0, "is_emergency": False, "on_ground": False, "region": "delhi", "lat": 1.0, "lon": 2.0}
    rows = [
        {"hex": "a", "flight": "AI101", "aircraft_type": "B738", "altitude_ft": 1000.0, "gs_knots": 100.0},
        {"hex": "b", "flight": "AI102", "aircraft_type": None, "altitude_ft": 0.0, "on_ground": True, "lat": None},
        {"hex": "c", "flight": None, "aircraft_type": "B738", "is_emergency": True, "on_ground": None, "region": "mumbai"},
        {"hex": "d", "flight": "AI102", "aircraft_type": "A20N", "last_seen": NOW},
    ]
    return frame(spark, schemas.CURRENT_L, [{**base, **r} for r in rows])


def keys(df):
    return [r.hex for r in df.collect()]


def test_live_flights(fleet):
    assert keys(serving.live_flights(fleet)) == ["d", "a", "b", "c"]
    assert keys(serving.live_flights(fleet, region="mumbai")) == ["c"]
    assert keys(serving.live_flights(fleet, emergency_only=True)) == ["c"]
    assert keys(serving.live_flights(fleet, airborne_only=True)) == ["d", "a"]
    assert keys(serving.live_flights(fleet, limit=1)) == ["d"]


def test_no_limit_gives_everything(fleet):
    assert serving.live_flights(fleet).count() == serving.live_flights(fleet, limit=100_000).count() == 4


def test_geojson(fleet):
    features = {r.hex: json.loads(r.feature) for r in serving.geojson(fleet).collect()}
    assert set(features) == {"a", "c", "d"} and serving.feature_count(fleet).first()["count"] == 3
    assert features["c"]["type"] == "Feature"
    assert features["c"]["geometry"] == {"type": "Point", "coordinates": [2.0, 1.0]}
    assert features["c"]["properties"]["flight"] is None and "lat" not in features["c"]["properties"]


def test_measures(fleet):
    row = serving.measures(fleet).first()
    assert (row.active_flights, row.airborne_count, row.on_ground_count) == (4, 2, 1)
    assert (row.unique_aircraft_types, row.unique_airlines, row.emergency_rate_pct) == (3, 3, 25.0)
    assert serving.measures(fleet.limit(0)).first().emergency_rate_pct == 0.0


def test_top_callsigns_keeps_ties(fleet):
    assert {r.flight for r in serving.top_callsigns(fleet, 1).collect()} == {"AI102"}
    assert serving.top_callsigns(fleet, 2).count() == 3


def test_kpis_of_empty_state(fleet):
    values = {r.kpi_name: r.kpi_value for r in marts.kpis(fleet.limit(0), NOW).collect()}
    assert values["active_flights"] == 0.0 and values["avg_altitude_ft"] is None and len(values) == 8


def test_growth(spark):
    hours = [(datetime(2026, 6, d, h), "delhi", n) for d, h, n in ((1, 5, 10), (1, 6, 20), (2, 5, 30), (4, 1, 5))]
    trend = spark.createDataFrame(hours, "hour_bucket timestamp, region string, flight_count bigint")
    growth = {r.day.day: r.growth_pct for r in serving.growth_day_over_day(trend).collect()}
    assert growth == {1: 0.0, 2: 50.0, 4: 0.0}


def test_windows_take_a_time(spark):
    rows = [(NOW - timedelta(hours=h), "delhi", h) for h in (1, 24, 25)]
    m = spark.createDataFrame(rows, "metric_time timestamp, region string, n int")
    assert [r.n for r in serving.metrics_window(m, hours=24, as_of=NOW).collect()] == [1, 24]


def test_kpi_snapshot_nulls_are_zero(spark):
    empty = spark.createDataFrame([], schemas.CURRENT_N)
    rows = kpis.kpi_snapshot(empty, spark.createDataFrame([], schemas.CLEAN_N), NOW).collect()
    assert len(rows) == 8 and {r.metric_value for r in rows} == {0.0} and {r.snapshot_at for r in rows} == {NOW}


def test_aircraft_dim_activity(spark):
    rows = [{"hex": h, "ingested_at": NOW - timedelta(minutes=m)} for h, m in (("on", 4), ("edge", 5), ("off", 6))]
    dim = marts.aircraft_dim(frame(spark, schemas.CLEAN_L, rows), NOW)
    assert {r.hex: r.is_active for r in dim.collect()} == {"on": True, "edge": False, "off": False}


def test_region_summary_commonest_type(spark, fleet):
    log = frame(spark, schemas.CLEAN_L, [{"hex": "a", "region": "delhi", "aircraft_type": t} for t in ("X", "Y", "Y", None, None, None)])
    rows = {r.region: r for r in marts.region_summary(fleet, log, NOW).collect()}
    assert (rows["delhi"].top_aircraft_type, rows["delhi"].total_flights) == ("Y", 3)
    assert rows["mumbai"].top_aircraft_type is None


def test_required_columns(spark):
    rows = frame(spark, schemas.CDC_N, [{"hex": None, "change_type": "NEW", "detected_at": NOW}])
    assert quality.missing_required(rows, schemas.REQUIRED["cdc"]).first().null_hex == 1
    with pytest.raises(Exception, match="required column hex"):
        quality.require(rows, ["hex"]).collect()
    assert quality.require(rows, ["detected_at"]).count() == 1


def test_corrupt_times(raw_rows):
    assert quality.corrupt_times(raw_rows({}, {"fetched_at": datetime(5842, 1, 1)})).count() == 1
