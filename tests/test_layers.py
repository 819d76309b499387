from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import NOW, T0
from pyspark.sql import functions as F

from contrail import schemas
from contrail.functions import columns as C
from contrail.operators import cdc, clean, lifecycle, scd2, state
from contrail.plans import medallion
from contrail.sources.tables import Lake
from contrail.streaming import feeds

MIN = timedelta(minutes=1)


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def polls(raw_rows):
    """Four polls ten minutes apart: 'away' vanishes after the first and returns in the third."""
    def poll(i, *keys):
        at = T0 + 10 * i * MIN
        rows = [{"ingestion_id": f"{i}-{k}", "hex": k, "fetched_at": at, "gs": 100.0 + i * 20, "flight": f"F{k}{i // 2}"} for k in keys]
        return at, raw_rows(*rows, {"ingestion_id": f"{i}-dup", "hex": keys[0], "fetched_at": at, "seen": 1.0},
                            {"ingestion_id": f"{i}-bad", "hex": "lost", "fetched_at": at, "lat": 200.0})

    return [poll(0, "stay", "away"), poll(1, "stay"), poll(2, "stay", "away"), poll(3, "stay", "new1")]


def step_by_frames(spark, batches):
    """The same cycle on whole frames, nothing stored: what the stored layer must match."""
    st = spark.createDataFrame([], schemas.CURRENT_N)
    log = spark.createDataFrame([], schemas.CLEAN_N)
    hist = spark.createDataFrame([], schemas.HISTORY_N)
    events = spark.createDataFrame([], schemas.CDC_N)
    for at, raw in batches:
        st, back = lifecycle.reactivate(st, raw, at)
        new = clean.clean_observations(raw, "N", as_of=at)
        log = log.unionByName(new)
        since = raw.agg(F.min("fetched_at")).first()[0] - MIN
        changed = cdc.cdc_long(log, since=since, as_of=at)
        st = state.merge_current(st, clean.latest_observation(new), as_of=at)
        st, log, lost = lifecycle.mark_disappeared(st, raw, log, events, as_of=at)
        hist = scd2.scd2_apply(hist, st, "N", at)
        events = events.unionByName(changed).unionByName(back).unionByName(lost)
        # Plans would grow with every step; a plain round trip cuts them.
        st, log, hist, events = (
            spark.createDataFrame(df.collect(), df.schema) for df in (st, log, hist, events)
        )
    return st, log, hist, events


def test_stored_layer_equals_frames_and_replay_changes_nothing(spark, polls, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for i, (at, raw) in enumerate(polls):
        medallion.run_silver(lake, raw, i, at)
    st, log, hist, events = step_by_frames(spark, polls)

    def stored():
        return (
            rows_of(medallion.read_current(lake)), rows_of(medallion.read_clean(lake)),
            rows_of(medallion.read_history(lake)), rows_of(lake.read_log("cdc", schemas.CDC_N).drop("batch_id")),
        )

    got = stored()
    for have, want in zip(got, (st, log, hist, events)):
        assert have == rows_of(want)
    away = [r for r in st.collect() if r.hex == "away"][0]
    assert (away.is_deleted, away.deleted_reason) == (True, C.DISAPPEARED)
    kinds = [r.change_type for r in events.filter("hex = 'away'").orderBy("detected_at").collect()]
    assert kinds.count("DISAPPEARED") == 2 and kinds.count("NEW") == 3  # first, back, and anew

    last_at, last = polls[-1]
    medallion.run_silver(lake, last, 3, last_at)
    assert stored() == got
    assert lake.last_commit() == 3 and lake.commits().count() == 4


def test_uncommitted_batch_is_invisible(spark, polls, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    medallion.run_silver(lake, polls[0][1], 0, polls[0][0])
    lake.write_log("clean", lake.read_batch("clean", medallion.CLEAN_N, 0), 1)
    assert lake.read_log("clean", medallion.CLEAN_N).filter("batch_id = 1").count() == 0


def test_stream_runs_equal_batch_runs(spark, polls, tmp_path):
    batch, stream = Lake(spark, str(tmp_path / "b")), Lake(spark, str(tmp_path / "s"))
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")
    for i, (at, raw) in enumerate(polls[:2]):
        medallion.run_silver(batch, raw, i, at)
        raw.write.mode("append").parquet(landing)
        source = spark.readStream.schema(schemas.RAW_N).parquet(landing)
        feeds.write_silver(source, stream, progress, clock=lambda at=at: at).awaitTermination()
    assert rows_of(medallion.read_current(batch)) == rows_of(medallion.read_current(stream))
    assert rows_of(medallion.read_history(batch)) == rows_of(medallion.read_history(stream))


def test_local_profile_and_gold(spark, raw_l_rows, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    first = raw_l_rows({"hex": "A", "flight": "AI101"}, {"hex": "b", "flight": "SG202", "alt_baro": "ground"})
    medallion.run_all(spark, lake.root, first, 0, T0, "L")
    second = raw_l_rows({"hex": "a", "flight": "AI101", "alt_baro": "36000", "_ingested_at": NOW})
    medallion.run_all(spark, lake.root, second, 1, NOW, "L")
    history = medallion.read_history(lake, "history_l", schemas.HISTORY_L)
    assert {(r.hex, r.is_current, r.change_reason) for r in history.collect()} == {
        ("a", False, "INITIAL_LOAD"), ("a", True, "CHANGED:altitude_ft"), ("b", True, "INITIAL_LOAD"),
    }
    events = lake.read_log("cdc_l", schemas.CDC_L).filter("batch_id = 1")
    assert {r.hex: r.cdc_event for r in events.collect()} == {"a": "ALT_CHANGE", "b": "UNCHANGED"}
    def marts_of_last():
        out = {}
        for name in medallion.GOLD_L:
            df = spark.read.parquet(f"{lake.path(name)}/version=1")
            out[name] = rows_of(df.select(*sorted(df.columns)))
        return out

    updated = marts_of_last()
    assert medallion.run_gold(lake, NOW, "L") == medallion.GOLD_L
    assert updated == marts_of_last() and all(updated.values())


def test_gold_of_profile_n(spark, polls, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for i, (at, raw) in enumerate(polls[:2]):
        medallion.run_all(spark, lake.root, raw, i, at)
    metrics = lake.read_log("metrics", schemas.METRICS_N)
    assert metrics.select("snapshot_at").distinct().count() == 2
    active = metrics.filter("metric_name = 'active_flights'").orderBy("snapshot_at").collect()
    assert [r.metric_value for r in active] == [2.0, 1.0]


def test_manual_delete_and_restore_in_the_store(spark, polls, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    medallion.run_silver(lake, polls[0][1], 0, T0)
    keys = spark.createDataFrame([("stay",)], "hex string")
    assert medallion.soft_delete_keys(lake, keys, NOW, "TEST") == 1
    gone = medallion.read_current(lake).filter("hex = 'stay'").first()
    assert (gone.is_deleted, gone.deleted_reason) == (True, "TEST")
    versions = {r.hex: r.is_current for r in medallion.read_history(lake).collect()}
    assert versions == {"stay": False, "away": True}
    assert medallion.restore_keys(lake, keys, NOW) == 2
    assert not medallion.read_current(lake).filter("hex = 'stay'").first().is_deleted
    medallion.run_silver(lake, polls[1][1], 3, polls[1][0])
    rows = medallion.read_history(lake).filter("hex = 'stay'").orderBy("effective_from").collect()
    assert [r.is_current for r in rows] == [False, True]


def test_repeated_epoch_is_taken_once(spark, polls, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    medallion.run_silver(lake, polls[0][1], 0, T0, source="stream#0")
    assert lake.has_taken("stream#0") and not lake.has_taken("stream#1")


def test_clear_and_compact(spark, polls, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    medallion.run_silver(lake, polls[0][1].repartition(6), 0, polls[0][0])
    lake.compact("raw", schemas.RAW_N, 0, "raw_even")
    assert lake.read_batch("raw_even", schemas.RAW_N, 0).count() == lake.read_batch("raw", schemas.RAW_N, 0).count()
    assert lake.clear(medallion.SILVER_N) == [] and lake.exists(lake.path("raw"))
    assert set(lake.clear(medallion.SILVER_N, confirm=True)) == set(medallion.SILVER_N)
    assert not lake.exists(lake.path("raw"))
