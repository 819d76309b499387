from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import NOW, T0, frame
from pyspark.sql import functions as F

from contrail import schemas
from contrail.operators import cdc, clean, lifecycle, scd2, state

MIN = timedelta(minutes=1)


@pytest.fixture
def current(spark):
    def make(*rows):
        base = {"callsign": "AI101", "last_seen_at": T0, "is_deleted": False, "_updated_at": T0}
        return frame(spark, schemas.CURRENT_N, [{**base, **r} for r in rows])

    return make


@pytest.fixture
def current_l(spark):
    def make(*rows):
        base = {
            "flight": "AI101", "registration": "VT-ANF", "squawk": "2041", "lat": 17.5, "lon": 78.9,
            "altitude_ft": 30000.0, "gs_knots": 450.0, "track_deg": 90.0, "observed_at": T0,
        }
        return frame(spark, schemas.CURRENT_L, [{"hex": "abc123", **base, **r} for r in rows])

    return make


def cleaned(raw):
    return clean.clean_observations(raw, "N", as_of=NOW)


def by_hex(df):
    rows = df.collect()
    assert len(rows) == len({r.hex for r in rows})
    return {r.hex: r for r in rows}


# ---- upsert ------------------------------------------------------------------
def test_merge_inserts_updates_and_clears(current, raw_rows):
    old = current(
        {"hex": "kept", "callsign": "OLD"},
        {"hex": "abc123", "is_deleted": True, "deleted_reason": "DISAPPEARED", "deleted_at": T0},
    )
    latest = clean.latest_observation(cleaned(raw_rows({"flight": "NEW1"}, {"hex": "fresh"})))
    rows = by_hex(state.merge_current(old, latest, as_of=NOW))
    assert set(rows) == {"kept", "abc123", "fresh"}
    assert (rows["kept"].callsign, rows["kept"]._updated_at) == ("OLD", T0)
    back = rows["abc123"]
    assert (back.callsign, back.is_deleted, back.deleted_at, back.deleted_reason) == ("NEW1", False, None, None)
    assert rows["fresh"]._updated_at == NOW


def test_merge_overwrites_with_null(current, raw_rows):
    latest = clean.latest_observation(cleaned(raw_rows({"squawk": None})))
    rows = by_hex(state.merge_current(current({"hex": "abc123", "squawk": "2041"}), latest, as_of=NOW))
    assert rows["abc123"].squawk is None


def test_merge_twice_is_merge_once(current, raw_rows):
    latest = clean.latest_observation(cleaned(raw_rows({}, {"hex": "x"})))
    once = state.merge_current(current({"hex": "kept"}), latest, as_of=NOW)
    twice = state.merge_current(once, latest, as_of=NOW)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


def test_soft_delete_and_restore(spark, current):
    rows = current({"hex": "a"}, {"hex": "b"})
    history = scd2.scd2_apply(spark.createDataFrame([], schemas.HISTORY_N), rows, "N", T0)
    keys = spark.createDataFrame([("a",), ("a",), ("missing",)], "hex string")
    deleted, closed = state.soft_delete(rows, history, keys, "TEST", NOW)
    got, versions = by_hex(deleted), by_hex(closed)
    assert (got["a"].is_deleted, got["a"].deleted_reason, got["a"].deleted_at) == (True, "TEST", NOW)
    assert not got["b"].is_deleted and versions["b"].is_current
    assert (versions["a"].is_current, versions["a"].effective_to) == (False, NOW)
    assert [r.hex for r in state.soft_deleted(deleted).collect()] == ["a"]
    assert not by_hex(state.restore(deleted, keys, NOW))["a"].is_deleted
    assert not versions["a"].is_current


def test_change_feed(current):
    before = current({"hex": "same"}, {"hex": "moved", "lat": 1.0}, {"hex": "gone"})
    after = current({"hex": "same"}, {"hex": "moved", "lat": None}, {"hex": "came"})
    feed = {(r.hex, r._change_type): r.lat for r in state.change_feed(before, after).collect()}
    assert feed == {
        ("moved", "update_preimage"): 1.0, ("moved", "update_postimage"): None,
        ("gone", "delete"): None, ("came", "insert"): None,
    }


# ---- versions ----------------------------------------------------------------
def test_scd2_altitude_change(spark, current_l):
    first = scd2.scd2_apply(spark.createDataFrame([], schemas.HISTORY_L), current_l({}), "L", T0)
    assert first.first().change_reason == "INITIAL_LOAD"
    second = scd2.scd2_apply(first, current_l({"altitude_ft": 35000.0}), "L", NOW).orderBy("effective_from").collect()
    assert [(r.effective_from, r.effective_to, r.is_current) for r in second] == [(T0, NOW, False), (NOW, None, True)]
    assert second[1].change_reason == "CHANGED:altitude_ft"
    assert second[1].history_id == "abc123_2026-06-08T08:00:00+00:00"


def test_scd2_untracked_change_and_replay_do_nothing(spark, current_l):
    first = scd2.scd2_apply(spark.createDataFrame([], schemas.HISTORY_L), current_l({}), "L", T0)
    assert scd2.scd2_apply(first, current_l({"track_deg": 1.0}), "L", NOW).count() == 1
    assert scd2.scd2_apply(first, current_l({}), "L", NOW).count() == 1


def test_scd2_null_to_value(spark, current):
    none = spark.createDataFrame([], schemas.HISTORY_N)
    first = scd2.scd2_apply(none, current({"hex": "a", "aircraft_type": None}), "N", T0)
    typed = current({"hex": "a", "aircraft_type": "B738"})
    assert scd2.scd2_apply(first, typed, "N", NOW).count() == 2
    assert scd2.scd2_apply(first, typed, "N", NOW, null_safe=False).count() == 1


def test_scd2_ignores_deleted_keys_and_keeps_absent_ones_open(spark, current):
    none = spark.createDataFrame([], schemas.HISTORY_N)
    first = scd2.scd2_apply(none, current({"hex": "a"}, {"hex": "b", "is_deleted": True}), "N", T0)
    assert [r.hex for r in first.collect()] == ["a"]
    later = scd2.scd2_apply(first, current({"hex": "c"}), "N", NOW)
    assert {r.hex: r.is_current for r in later.collect()} == {"a": True, "c": True}


def test_scd2_invariants(spark, current):
    history = spark.createDataFrame([], schemas.HISTORY_N)
    for step in range(4):
        rows = [{"hex": f"h{i}", "callsign": f"C{(step * i) % 3}"} for i in range(8)]
        history = scd2.scd2_apply(history, current(*rows), "N", T0 + step * MIN)
    open_rows = history.filter("is_current").groupBy("hex").count()
    assert open_rows.filter("count <> 1").count() == 0 and open_rows.count() == 8
    a, b = history.alias("a"), history.alias("b")
    overlap = a.join(b, "hex").filter(
        "a.effective_from < b.effective_from AND coalesce(a.effective_to, timestamp '9999-01-01') > b.effective_from"
    )
    assert overlap.count() == 0
    assert history.select("flight_sk").distinct().count() == history.count()


# ---- change events -----------------------------------------------------------
def test_cdc_long_kinds_and_limits(raw_rows):
    old = {"fetched_at": T0, "lat": 10.0, "lon": 20.0, "alt_baro": 1000, "gs": 100.0, "track": 10.0}
    new = {"fetched_at": NOW, "lat": 10.002, "lon": 20.0, "alt_baro": 1101, "gs": 110.5, "track": 15.5}
    at_limit = {"fetched_at": NOW, "lat": 10.0, "lon": 20.0, "alt_baro": 1100, "gs": 110.0, "track": 15.0}
    raw = raw_rows(
        {"hex": "all", **old}, {"hex": "all", **new}, {"hex": "none", **old}, {"hex": "none", **at_limit},
        {"hex": "one", **old},
    )
    rows = cdc.cdc_long(cleaned(raw), as_of=NOW).collect()
    kinds = {(r.hex, r.change_type): (r.old_value, r.new_value) for r in rows}
    assert set(kinds) == {
        ("all", "POSITION"), ("all", "ALTITUDE"), ("all", "SPEED"), ("all", "HEADING"), ("one", "NEW")
    }
    assert kinds["all", "POSITION"] == ("10.0,20.0", "10.002,20.0")
    assert kinds["all", "ALTITUDE"] == ("1000", "1101")
    assert kinds["one", "NEW"] == (None, "lat=10.0,lon=20.0")
    assert {r.event_at for r in rows if r.hex == "all"} == {NOW}


def test_cdc_long_null_counts_as_zero_and_compares_two_newest(raw_rows):
    raw = raw_rows(
        {"fetched_at": T0, "alt_baro": 5000}, {"fetched_at": T0 + MIN, "alt_baro": None},
        {"fetched_at": NOW, "alt_baro": 200},
    )
    rows = {r.change_type: r for r in cdc.cdc_long(cleaned(raw)).collect()}
    assert (rows["ALTITUDE"].old_value, rows["ALTITUDE"].new_value) == (None, "200")


def test_cdc_since_and_wrap(raw_rows):
    raw = raw_rows({"fetched_at": T0, "track": 359.0}, {"fetched_at": NOW, "track": 1.0})
    kinds = lambda **kw: {r.change_type for r in cdc.cdc_long(cleaned(raw), **kw).collect()}
    assert kinds() == {"HEADING"} and kinds(wrap_heading=True) == set() and kinds(since=NOW) == set()


def test_cdc_from_state_equals_cdc_from_log(raw_rows, current):
    raw = raw_rows(
        {"fetched_at": T0, "gs": 100.0}, {"fetched_at": NOW, "gs": 200.0}, {"hex": "x", "fetched_at": NOW},
        {"hex": "y", "fetched_at": T0},
    )
    rows = cleaned(raw)
    first, second = rows.filter(F.col("fetched_at") <= T0), rows.filter(F.col("fetched_at") > T0)
    known = state.merge_current(current().limit(0), clean.latest_observation(first), as_of=T0)
    inc = cdc.cdc_long(cdc.with_previous_state(second, known), as_of=NOW)
    full = cdc.cdc_long(rows, since=T0, as_of=NOW)
    assert sorted(map(repr, inc.collect())) == sorted(map(repr, full.collect()))


def test_cdc_wide(current_l):
    old = current_l({"hex": "same"}, {"hex": "move"}, {"hex": "null", "altitude_ft": None}, {"hex": "edge"})
    new = current_l(
        {"hex": "same"}, {"hex": "move", "lat": 17.6, "altitude_ft": 30051.0, "gs_knots": 456.0, "track_deg": 93.0},
        {"hex": "null", "altitude_ft": 500.0}, {"hex": "edge", "altitude_ft": 30050.0, "gs_knots": 455.0, "track_deg": 92.0},
        {"hex": "new"},
    )
    rows = by_hex(cdc.cdc_wide(old, new, as_of=NOW))
    assert {h: r.cdc_event for h, r in rows.items()} == {
        "same": "UNCHANGED", "edge": "UNCHANGED", "null": "UNCHANGED", "new": "NEW",
        "move": "POSITION_CHANGE|ALT_CHANGE|SPEED_CHANGE|HEADING_CHANGE",
    }
    assert (rows["move"].old_lat, rows["move"].new_lat, rows["new"].old_lat) == (17.5, 17.6, None)
    zero = by_hex(cdc.cdc_wide(old, new, as_of=NOW, null_as_zero=True))
    assert zero["null"].cdc_event == "ALT_CHANGE"


# ---- vanish and return -------------------------------------------------------
def test_grace_period(raw_rows, current):
    raw = raw_rows({"hex": "polled", "fetched_at": NOW})
    ages = {"a4": 4, "a5": 5, "a6": 6, "polled": 30}
    rows = current(*[{"hex": h, "last_seen_at": NOW - m * MIN} for h, m in ages.items()],
                   {"hex": "dead", "is_deleted": True, "last_seen_at": T0})
    assert {r.hex for r in lifecycle.vanished(rows, raw).collect()} == {"a6"}
    assert {r.hex for r in lifecycle.vanished(rows, raw, 0).collect()} == {"a4", "a5", "a6"}
    assert lifecycle.vanished(rows, raw.limit(0)).count() == 0


def test_mark_disappeared_cascades_and_suppresses(spark, raw_rows, current):
    raw = raw_rows({"hex": "old", "fetched_at": T0}, {"hex": "old", "fetched_at": T0, "seen": 1.0}, {"hex": "polled", "fetched_at": NOW})
    rows = current({"hex": "old"}, {"hex": "polled", "last_seen_at": NOW})
    none = spark.createDataFrame([], schemas.CDC_N)
    new_state, new_clean, events = lifecycle.mark_disappeared(rows, raw, cleaned(raw), none, as_of=NOW)
    assert by_hex(new_state)["old"].deleted_reason == "DISAPPEARED"
    reasons = sorted(str(r.deleted_reason) for r in new_clean.collect())
    assert reasons == ["DISAPPEARED", "DUPLICATE", "None"]
    event = events.first()
    assert (event.change_type, event.old_value, event.event_at) == ("DISAPPEARED", "2026-06-08 07:00:00", T0)
    _, kept, again = lifecycle.mark_disappeared(rows, raw, cleaned(raw), events, cascade_clean=False, as_of=NOW)
    assert again.count() == 0 and kept.filter("deleted_reason = 'DISAPPEARED'").count() == 0
    long_ago = events.withColumn("detected_at", F.lit(NOW - 11 * MIN))
    assert lifecycle.mark_disappeared(rows, raw, cleaned(raw), long_ago, as_of=NOW)[2].count() == 1


def test_reactivate(raw_rows, current):
    gone = {"is_deleted": True, "deleted_reason": "DISAPPEARED", "deleted_at": T0}
    rows = current({"hex": "back", **gone}, {"hex": "away", **gone},
                   {"hex": "manual", **gone, "deleted_reason": "MANUAL"})
    raw = raw_rows({"hex": "back", "fetched_at": NOW}, {"hex": "manual", "fetched_at": NOW}, {"hex": "away"})
    new_state, events = lifecycle.reactivate(rows, raw, NOW)
    assert {h: r.is_deleted for h, r in by_hex(new_state).items()} == {"back": False, "away": True, "manual": True}
    assert [(e.hex, e.change_type, e.old_value, e.new_value) for e in events.collect()] == [
        ("back", "NEW", "DISAPPEARED", "REACTIVATED")
    ]


def test_rates(spark, current):
    gone = {"is_deleted": True, "deleted_reason": "DISAPPEARED"}
    rows = current({"hex": "a"}, {"hex": "b"}, {"hex": "c", **gone, "deleted_at": NOW - 5 * MIN},
                   {"hex": "d", **gone, "deleted_at": NOW - 120 * MIN})
    got = lifecycle.disappearance_rate(rows, 60, NOW).first()
    assert (got.active_now, got.disappeared_in_window, got.disappearance_rate) == (2, 1, 33.33)
    assert lifecycle.disappearance_rate(rows.limit(0), 60, NOW).first().disappearance_rate == 0.0
    assert lifecycle.disappeared_since(rows, 60, NOW).first()[0] == 1
    events = frame(spark, schemas.CDC_N, [
        {"hex": "c", "change_type": "DISAPPEARED", "detected_at": NOW - 5 * MIN},
        {"hex": "c", "change_type": "DISAPPEARED", "detected_at": NOW - 5 * MIN},
        {"hex": "d", "change_type": "DISAPPEARED", "detected_at": NOW - 120 * MIN},
    ])
    rows = lifecycle.disappearance_by_minute(events, rows, 60, NOW).collect()
    assert [(r.disappeared_count, r.total_active, r.rate_pct) for r in rows] == [(1, 2, 50.0)]
