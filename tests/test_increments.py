"""State, versions, events and marts that follow from batches, against the whole log."""

from __future__ import annotations

import random
from datetime import timedelta
from pathlib import Path

import pytest
from conftest import NOW, T0, frame
from pyspark.sql import functions as F

from contrail import schemas
from contrail.operators import cdc, clean, islands, state
from contrail.plans import bitmaps, kpis, marts, medallion, routes
from contrail.sources import parted
from contrail.sources.tables import Lake

MIN, DAY = timedelta(minutes=1), timedelta(days=1)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def files(table):
    return {p: p.stat().st_mtime_ns for p in Path(table.path).rglob("*.parquet")}


# ---- state in buckets ----------------------------------------------------------
def test_a_key_rewrites_one_bucket(spark, raw_rows, tmp_path):
    table = parted.bucketed(spark, str(tmp_path / "state"), schemas.CURRENT_N, 8, "hex")
    rows = clean.clean_observations(raw_rows(*[{"hex": f"k{i}"} for i in range(40)]), as_of=T0)
    assert len(state.merge_buckets(table, clean.latest_observation(rows), 0, T0)) > 4
    before = files(table)
    one = clean.latest_observation(clean.clean_observations(raw_rows({"hex": "k7", "gs": 9.0, "fetched_at": NOW}), as_of=NOW))
    (touched,) = state.merge_buckets(table, one, 1, NOW)
    after = files(table)
    gone = set(before) - set(after)
    assert gone and {p.parent.name for p in gone} == {f"_part={touched}"}
    assert all(after[p] == before[p] for p in set(before) & set(after))
    assert table.read().count() == 40 and table.read().filter("gs = 9.0").count() == 1
    plan = table.read([touched])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_part" in plan or "PartitionFilters: [isnotnull(_part" in plan
    assert state.merge_buckets(table, one.limit(0), 2, NOW) == []


def test_buckets_equal_one_merge(spark, raw_rows, tmp_path):
    rnd = random.Random(3)
    table = parted.bucketed(spark, str(tmp_path / "state"), schemas.CURRENT_N, 4, "hex")
    whole = spark.createDataFrame([], schemas.CURRENT_N)
    for i in range(4):
        raw = raw_rows(*[{"hex": f"k{rnd.randrange(12)}", "fetched_at": T0 + (10 * i + j) * MIN, "gs": 1.0 * j} for j in range(6)])
        latest = clean.latest_observation(clean.clean_observations(raw, as_of=T0))
        for _ in range(2):  # a batch run again changes nothing
            state.merge_buckets(table, latest, i, T0 + i * MIN)
        whole = spark.createDataFrame(state.merge_current(whole, latest, as_of=T0 + i * MIN).collect(), schemas.CURRENT_N)
    assert rows_of(table.read()) == rows_of(whole)


# ---- marts of profile N ----------------------------------------------------------
@pytest.fixture
def polls(raw_rows):
    """Six polls ten minutes apart: 'away' vanishes twice, 'last' for good; routes change under way."""
    keys = [("stay", "away", "last"), ("stay",), ("stay", "away"), ("stay", "new1"), ("stay", "away", "new1"), ("stay",)]

    def poll(i):
        at = T0 + 10 * i * MIN
        rows = [
            {"ingestion_id": f"{i}-{k}", "hex": k, "fetched_at": at, "gs": 100.1 + i * 7, "alt_baro": 1000 * i + len(k), "lat": 10.0 + i, "lon": -5.0 * i,
             "flight": None if k == "new1" and i == 3 else f"RT{(len(k) + i) // 3}", "source_region": ("delhi", "mumbai")[i % 2], "aircraft_type": (None, "B738")[i % 2]}
            for k in keys[i]
        ]
        return at, raw_rows(*rows, {"ingestion_id": f"{i}-bad", "hex": "lost", "fetched_at": at, "lat": 200.0})

    return [poll(i) for i in range(6)]


def gold_rows(lake, name, version):
    log = name in ("metrics", "route_summary")
    df = lake.spark.read.parquet(f"{lake.path(name)}/{'batch_id' if log else 'version'}={version}")
    return rows_of(df)


def test_routes_by_deltas_equal_the_log(spark, polls, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for i, (at, raw) in enumerate(polls):
        medallion.run_silver(lake, raw, i, at)
        if i in (1, 4):  # marts left out for a commit
            continue
        medallion.update_gold(lake, at)
        made = {n: gold_rows(lake, n, i) for n in ("metrics", "route_summary", "hotspots")}
        log = medallion.read_clean(lake)
        assert made["route_summary"] == rows_of(kpis.route_summary(log, at))
        assert made["metrics"] == rows_of(kpis.kpi_snapshot(medallion.read_current(lake), log, at))
    lives = lake.read_state("route_lives", routes.LIVES)
    assert {r.hex for r in lives.collect()} == {"stay"} | {"new1"} - {r.hex for r in lake.read_log("marks", schemas.MARKS).collect()}


class Dying(Lake):
    """Dies at the write of its given number, or at the marker behind it."""

    def __init__(self, spark, root, at):
        super().__init__(spark, root)
        self.left = at

    def _count(self, what):
        self.left -= 1
        if self.left < 0:
            raise InterruptedError(what)

    def write_state(self, table, df, version):
        self._count(table)
        super().write_state(table, df, version)

    def write_log(self, table, df, batch_id):
        self._count(table)
        super().write_log(table, df, batch_id)

    def mark(self, table, version):
        self._count(f"mark {table}")
        super().mark(table, version)


@pytest.mark.parametrize("at", [1, 2, 4])
def test_routes_after_a_crash(spark, polls, tmp_path, at):
    lake = Lake(spark, str(tmp_path / "lake"))
    for i in range(2):
        medallion.run_silver(lake, polls[i][1], i, polls[i][0])
        if i == 0:
            medallion.update_gold(lake, polls[0][0])
    with pytest.raises(InterruptedError):
        medallion.update_gold(Dying(spark, lake.root, at), polls[1][0])
    medallion.run_silver(lake, polls[2][1], 2, polls[2][0])
    medallion.update_gold(lake, NOW)
    assert gold_rows(lake, "route_summary", 2) == rows_of(kpis.route_summary(medallion.read_clean(lake), NOW))


@pytest.mark.parametrize("at", [3, 9])
def test_local_marts_after_a_crash(spark, raw_l_rows, tmp_path, at):
    lake = Lake(spark, str(tmp_path / "lake"))
    for i in range(3):
        batch = raw_l_rows(*[{"hex": f"k{j}", "flight": f"AI{j}", "aircraft_type": "B738", "_ingested_at": T0 + i * MIN} for j in range(2 + i)])
        medallion.run_silver_local(lake, batch, i, T0 + i * MIN)
        if i == 1:
            with pytest.raises(InterruptedError):
                medallion.update_gold_local(Dying(spark, lake.root, at), T0)
        else:
            medallion.update_gold_local(lake, NOW)
    got = {n: gold_rows(lake, n, 2) for n in medallion.GOLD_L}
    medallion.run_gold(lake, NOW, "L")
    assert got == {n: gold_rows(lake, n, 2) for n in medallion.GOLD_L}


def test_events_are_suppressed_by_the_state(spark, polls, tmp_path):
    for minutes, times in ((10, 2), (60, 1)):
        lake = Lake(spark, str(tmp_path / f"lake{minutes}"))
        for i, (at, raw) in enumerate(polls):
            medallion.run_silver(lake, raw, i, at, suppress_minutes=minutes)
        events = lake.read_log("cdc", schemas.CDC_N).filter("change_type = 'DISAPPEARED' AND hex = 'away'")
        vanished = lake.read_log("marks", schemas.MARKS).filter("hex = 'away'").count()
        assert (events.count(), vanished) == (times if minutes == 60 else vanished, vanished) and vanished >= 2


# ---- every change ------------------------------------------------------------------
def log_of(spark, rows):
    base = {"is_deleted": False, "lat": 1.0, "lon": 2.0}
    return frame(spark, schemas.CLEAN_N, [{**base, "ingestion_id": f"{i:04}", **r} for i, r in enumerate(rows)])


def test_three_changes_of_a_key_in_a_batch(spark):
    names = ["A", "A", "B", None, "B", "B", "C"]
    rows = [{"hex": "k", "callsign": n, "alt_baro": 1000 * i, "fetched_at": T0 + i * 7 * timedelta(hours=1)} for i, n in enumerate(names)]
    log = log_of(spark, [*rows, {"hex": "other", "callsign": "X", "fetched_at": T0}, {"hex": "k", "callsign": "gone", "fetched_at": T0, "is_deleted": True}])
    got = islands.scd2_from_log(log).filter("hex = 'k'").orderBy("version").collect()
    assert [(r.callsign, r.version, r.is_current) for r in got] == [("A", 1, False), ("B", 2, False), (None, 3, False), ("B", 4, False), ("C", 5, True)]
    assert [r.effective_to for r in got[:-1]] == [r.effective_from for r in got[1:]] and got[-1].effective_to is None
    assert [r.change_reason for r in got[:2]] == ["INITIAL_LOAD", "CHANGED:callsign"]
    events = islands.cdc_from_log(log, as_of=NOW).filter("hex = 'k' AND change_type = 'ALTITUDE'").orderBy("event_at").collect()
    assert [(r.old_value, r.new_value) for r in events] == [(str(1000 * i), str(1000 * (i + 1))) for i in range(6)]


def test_versions_and_events_of_random_logs(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(300):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(8)}"
        rows.append({"hex": key, "callsign": rnd.choice("AB"), "aircraft_type": rnd.choice([None, "T"]), "gs": 20.0 * rnd.randrange(4), "fetched_at": T0 + (37 * i) * MIN})
    log = log_of(spark, rows)
    want = []
    for key in {r["hex"] for r in rows}:
        last = None
        for r in sorted((r for r in rows if r["hex"] == key), key=lambda r: r["fetched_at"]):
            now = (r["callsign"], r["aircraft_type"])
            if last is None or now != last[0]:
                if last:
                    want[-1] = (*want[-1][:4], r["fetched_at"])
                want.append((key, *now, r["fetched_at"], None))
                last = (now,)
    got = islands.scd2_from_log(log).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.hex, r.callsign, r.aircraft_type, r.effective_from, r.effective_to)) for r in got)
    # In three batches, each with what the one before left open.
    done, opened = [], None
    for lo, hi in ((0, 100), (100, 101), (101, 300)):
        part = islands.scd2_from_log(log_of(spark, rows[lo:hi]), opened=opened)
        part = spark.createDataFrame(part.collect(), part.schema)
        done += part.filter("NOT is_current").collect()
        opened = part.filter("is_current")
    done += opened.collect()
    assert sorted(map(repr, want)) == sorted(repr((r.hex, r.callsign, r.aircraft_type, r.effective_from, r.effective_to)) for r in done)
    # The newest pair of every key gives what the newest-pair operator gives.
    newest = log.groupBy("hex").agg(F.max("fetched_at").alias("event_at"))
    every = islands.cdc_from_log(log, as_of=NOW).join(newest, ["hex", "event_at"])
    assert rows_of(every) == rows_of(cdc.cdc_long(log, as_of=NOW))


def test_windows_run_over_days(spark):
    rows = log_of(spark, [{"hex": "k", "callsign": "A", "fetched_at": T0}])
    plan = islands.cdc_from_log(rows, as_of=NOW)._jdf.queryExecution().analyzed().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert windows and sum("_chunk" not in line.split("windowspecdefinition", 1)[1] for line in windows) == 0


# ---- bitmaps -------------------------------------------------------------------------
def test_bitmaps_equal_the_marts(spark, tmp_path):
    rnd = random.Random(4)
    rows = [
        {"hex": f"k{rnd.randrange(90)}", "flight": rnd.choice([None, "AI1", "AI2", "B"]), "region": rnd.choice(["r", "s", None]), "altitude_ft": rnd.choice([None, 100.0]),
         "gs_knots": 0.25 * rnd.randrange(99), "on_ground": rnd.choice([True, False, None]), "is_emergency": rnd.random() < 0.1,
         "ingested_at": rnd.choice([None, T0 + rnd.randrange(5) * MIN, T0 + DAY])}
        for _ in range(160)
    ]
    log = frame(spark, schemas.CLEAN_L, rows)
    for unit, mart, build in (("minute", bitmaps.minute_metrics, marts.minute_metrics), ("hour", bitmaps.hourly_trend, marts.hourly_trend)):
        store = bitmaps.Store(spark, str(tmp_path / unit), unit)
        for i in range(2):
            part = frame(spark, schemas.CLEAN_L, rows[80 * i : 80 * i + 80])
            bitmaps.fold(store, part, i)
            if i:
                bitmaps.fold(store, part, i)  # run again
        assert rows_of(mart(store)) == rows_of(build(log))
        numbers = [r.num for r in store.numbers("hex").read().collect()]
        assert len(set(numbers)) == len(numbers) == len({r["hex"] for r in rows})
        plan = mart(store)._jdf.queryExecution().executedPlan().toString()
        assert "clean" not in plan and "Expand" not in plan


def test_a_batch_reaches_only_the_days_that_lack_it(spark, tmp_path):
    day = lambda d, h: frame(spark, schemas.CLEAN_L, [{"hex": h, "region": "r", "ingested_at": T0 + d * DAY}])
    store = bitmaps.Store(spark, str(tmp_path), "hour")
    bitmaps.fold(store, day(0, "a"), 0)
    batch = day(0, "b").unionByName(day(1, "b"))
    # As if the run had died between two days of the totals.
    store.totals.change(bitmaps.totals_of(day(1, "b"), "hour"), bitmaps.merge_totals, 1)
    bitmaps.fold(store, batch, 1)
    assert sorted(r.total_flights for r in store.totals.read().collect()) == [1, 2]
    assert sorted(r.flight_count for r in bitmaps.hourly_trend(store).collect()) == [1, 2]
