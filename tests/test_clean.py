from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import NOW, T0
from pyspark.sql import functions as F

from contrail.functions import columns as C
from contrail.functions.time import from_epoch_millis
from contrail.operators import clean, keyed


def n(raw, **kw):
    return {r.ingestion_id: r for r in clean.clean_observations(raw, "N", as_of=NOW, **kw).collect()}


def l(raw):
    return clean.clean_observations(raw, "L").collect()


@pytest.mark.parametrize(
    "flight, callsign, airline",
    [
        ("AI101   ", "AI101", "AI1"),
        ("igo7443", "igo7443", "IGO"),
        (None, "UNKNOWN", None),
        ("   ", "UNKNOWN", None),
        ("B7", "B7", None),
    ],
)
def test_callsign_and_airline(raw_rows, flight, callsign, airline):
    row = n(raw_rows({"flight": flight}))["id000"]
    assert (row.callsign, row.airline_icao) == (callsign, airline)


def test_ranges_null_the_value(raw_rows):
    altitudes = [-1001, -1000, 60000, 60001, None]
    got = n(raw_rows(*[{"hex": f"h{i}", "alt_baro": a} for i, a in enumerate(altitudes)]))
    assert [got[f"id{i:03}"].alt_baro for i in range(5)] == [None, -1000, 60000, None, None]
    speeds = [-1.0, 0.0, 1200.0, 1201.0, None]
    got = n(raw_rows(*[{"hex": f"h{i}", "gs": s} for i, s in enumerate(speeds)]))
    assert [got[f"id{i:03}"].gs for i in range(5)] == [None, 0.0, 1200.0, None, None]


def test_emergency_is_three_valued(raw_rows):
    cases = [
        ("7700", "none", True), ("2041", "general", True), ("2041", "none", False),
        ("2041", None, False), (None, "none", None), (None, None, None), (None, "minfuel", True),
    ]
    got = n(raw_rows(*[{"hex": f"h{i}", "squawk": s, "emergency": e} for i, (s, e, _) in enumerate(cases)]))
    assert [got[f"id{i:03}"].is_emergency for i in range(len(cases))] == [c[2] for c in cases]


def test_military_bit(raw_rows):
    flags = [None, 1, 2, 3]
    got = n(raw_rows(*[{"hex": f"h{i}", "db_flags": f} for i, f in enumerate(flags)]))
    assert [got[f"id{i:03}"].is_military for i in range(4)] == [False, True, False, True]


def test_invalid_position_beats_duplicate_and_keeps_value(raw_rows):
    got = n(
        raw_rows(
            {"lat": 90.0001, "seen": 1.0}, {"lat": 90.0001, "seen": 0.5}, {"hex": "x", "lon": None},
            {"hex": "y", "lat": float("nan")},
        )
    )
    assert {r.deleted_reason for r in got.values()} == {"INVALID_COORDS"}
    assert got["id000"].lat == 90.0001 and got["id000"].deleted_at == NOW


def test_duplicates_keep_smallest_seen_nulls_last(raw_rows):
    got = n(raw_rows({"seen": None}, {"seen": 5.0}, {"seen": 0.1}, {"seen": 0.1}))
    live = [k for k, r in got.items() if not r.is_deleted]
    assert live == ["id002"]
    assert got["id003"].deleted_reason == "DUPLICATE"
    only_null = n(raw_rows({"seen": None}, {"seen": None}))
    assert [k for k, r in only_null.items() if not r.is_deleted] == ["id000"]


def test_registration_default_and_null_key(raw_rows):
    got = n(raw_rows({"registration": None}, {"hex": None}))
    assert list(got) == ["id000"] and got["id000"].registration == "UNREGISTERED"


def test_high_water_mark_is_strict(raw_rows):
    at = [T0 - timedelta(minutes=1), T0, T0 + timedelta(minutes=1)]
    raw = raw_rows(*[{"hex": f"h{i}", "fetched_at": t} for i, t in enumerate(at)])
    assert set(n(raw, since=T0)) == {"id002"}
    done = clean.clean_observations(raw.filter(F.col("fetched_at") <= T0), "N", as_of=NOW)
    assert set(n(raw, since=clean.high_water_mark(done))) == {"id002"}
    assert len(n(raw, since=clean.high_water_mark(done.limit(0)))) == 3


@pytest.mark.parametrize(
    "text, altitude, ground, bad",
    [
        ("35000", 35000.0, False, False), ("ground", 0.0, True, False), ("Ground", 0.0, True, False),
        ("bad", None, False, None), ("-501", None, False, True), ("60001", None, False, True),
        (None, None, None, None),
    ],
)
def test_altitude_text(raw_l_rows, text, altitude, ground, bad):
    row = l(raw_l_rows({"alt_baro": text}))[0]
    assert (row.altitude_ft, row.on_ground, row.dq_bad_alt) == (altitude, ground, bad)


def test_l_normalises_and_flags(raw_l_rows):
    row = l(
        raw_l_rows(
            {"hex": " ABC123 ", "flight": " sg202 ", "registration": "vt-slb", "squawk": " ",
             "lat": 999.0, "lon": None, "gs": 1501.0, "emergency": " General "}
        )
    )[0]
    assert (row.hex, row.flight, row.registration, row.squawk) == ("abc123", "SG202", "VT-SLB", None)
    assert (row.lat, row.lon, row.gs_knots) == (None, None, None)
    assert (row.dq_missing_pos, row.dq_bad_speed, row.dq_missing_call) == (True, True, False)
    assert (row.emergency, row.is_emergency) == ("general", True)
    quiet = l(raw_l_rows({"emergency": "none", "squawk": "7700"}))[0]
    assert (quiet.emergency, quiet.is_emergency) == (None, False)


def test_bad_position_keeps_row(raw_l_rows):
    rows = l(raw_l_rows({"hex": "abc123"}, {"hex": "bad001", "lat": 999.0, "lon": 999.0}))
    assert {r.hex: r.lat for r in rows} == {"abc123": 17.5, "bad001": None}


def test_quarantine_by_year(raw_rows):
    raw = raw_rows({}, {"fetched_at": datetime(5000, 1, 1)}, {"fetched_at": None})
    usable, corrupt = clean.quarantine(raw)
    assert (usable.count(), corrupt.count()) == (2, 1)


def test_epoch_millis_drop_fraction(spark):
    df = spark.createDataFrame([(1780903677138,), (0,), (None,)], "ms bigint")
    got = [r[0] for r in df.select(from_epoch_millis(F.col("ms"))).collect()]
    assert got == [datetime(2026, 6, 8, 7, 27, 57), None, None]


def test_lenient_casts(spark):
    df = spark.createDataFrame([("12",), ("12.7",), ("-3",), ("x",), ("",), (None,)], "t string")
    rows = df.select(C.lenient_int(F.col("t")), C.whole_number_or_null(F.col("t")), C.lenient_double(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [
        (12, 12, 12.0), (12, None, 12.7), (-3, -3, -3.0),
        (None, None, None), (None, None, None), (None, None, None),
    ]


def test_bands_and_cells(spark):
    df = spark.createDataFrame([(-1, -0.5), (0, 0.0), (9999, 12.9), (10000, 1.0), (20000, 2.0), (35000, 3.0)], "a int, d double")
    rows = df.select(C.altitude_band(F.col("a")), C.grid_index(F.col("d"))).collect()
    assert [r[0] for r in rows] == ["ground_level", "0_10k_ft", "0_10k_ft", "10k_20k_ft", "20k_35k_ft", "35k_plus_ft"]
    assert [r[1] for r in rows] == [-1, 0, 12, 1, 2, 3]


def test_heading_wraps_only_on_request(spark):
    df = spark.createDataFrame([(1.0, 359.0)], "a double, b double")
    row = df.select(C.heading_change(F.col("a"), F.col("b")), C.heading_change(F.col("a"), F.col("b"), True)).first()
    assert tuple(row) == (358.0, 2.0)


def test_load_stats(raw_rows):
    raw = raw_rows({"seen": 1.0}, {"seen": 2.0}, {"hex": "x", "lat": None}, {"hex": "y"})
    row = clean.load_stats(clean.clean_observations(raw, "N", as_of=NOW)).first()
    assert tuple(row) == (4, 2, 1, 1, 2)


def test_flag_duplicates_against_window(spark):
    """Same flags as ranking each group, with one group holding a third of the rows."""
    from pyspark.sql import Window

    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 9000)).alias("hex"),
        F.lit(T0).alias("fetched_at"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 13 % 50 / 2).alias("seen"),
        F.lpad(F.col("id").cast("string"), 8, "0").alias("ingestion_id"),
    )
    rank = F.row_number().over(
        Window.partitionBy("hex", "fetched_at").orderBy(F.col("seen").asc_nulls_last(), "ingestion_id")
    )
    both = keyed.flag_duplicates(df).withColumn("want", rank > 1)
    assert both.filter("is_duplicate <> want").count() == 0
    assert both.count() == 30000


def test_latest_keeps_one_row_per_key(raw_rows):
    raw = raw_rows({"fetched_at": T0}, {"fetched_at": NOW, "flight": "LATE"}, {"hex": "x"})
    rows = clean.latest_observation(clean.clean_observations(raw, "N", as_of=NOW)).collect()
    assert {r.hex: r.callsign for r in rows} == {"abc123": "LATE", "x": "UNKNOWN"}
