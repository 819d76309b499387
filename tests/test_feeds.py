"""Intake by whole paths, paging by key, feeds by digests, late and best rows, presence."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from conftest import NOW, T0, frame
from pyspark.sql import functions as F

from contrail import schemas
from contrail.operators import state
from contrail.plans import marts, serving
from contrail.sources import parted, snapshots
from contrail.sources.tables import Lake
from contrail.streaming import feeds

MIN = timedelta(minutes=1)


def rows_of(df):
    return sorted(map(repr, df.collect()))


# ---- intake ------------------------------------------------------------------
GOOD = '{"region": null, "ingested_at": "2026-06-08T07:00:00+00:00", "aircraft": [{"hex": "%s"}, {"hex": "b"}]}'


def land(root, region, day, name, text):
    folder = root / region / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_one_name_in_dated_folders_of_two_regions(spark, tmp_path):
    for region in ("delhi", "mumbai"):
        for day in ("2026-06-08", "2026-06-09"):
            land(tmp_path, region, day, "0700.json", GOOD % region)
    audit = spark.createDataFrame([], schemas.AUDIT)
    raw, done = snapshots.ingest_new(spark, str(tmp_path / "delhi"), audit, NOW, region_level=2)
    assert raw.count() == 4 and {r.region for r in done.collect()} == {"delhi"}
    done = spark.createDataFrame(done.collect(), schemas.AUDIT)
    found = snapshots.new_files(spark, str(tmp_path), done, region_level=2).collect()
    assert sorted((r.region, r.path.split("/")[-2]) for r in found) == [("mumbai", "2026-06-08"), ("mumbai", "2026-06-09")]


def test_stream_intake_takes_a_file_once_and_failed_files_again(spark, tmp_path):
    root, lake = tmp_path / "landing", Lake(spark, str(tmp_path / "lake"))
    land(root, "delhi", "08", "a.json", GOOD % "x")
    land(root, "mumbai", "08", "a.json", "{broken")
    land(root, "mumbai", "09", "a.json", '{"aircraft": []}')

    def run():
        query = snapshots.ingest_stream(spark, str(root), lake, str(tmp_path / "progress"), region_level=2, clock=lambda: NOW)
        query.awaitTermination()

    run()
    audit = lake.read_log("audit", schemas.AUDIT)
    assert sorted((r.region, r.status, r.records_loaded) for r in audit.collect()) == [("delhi", "OK", 2), ("mumbai", "ERROR", 0), ("mumbai", "OK", 0)]
    assert lake.read_log("raw_l", schemas.RAW_L).count() == 2
    run()
    assert lake.last_commit() == 0
    land(root, "delhi", "09", "a.json", GOOD % "y")
    run()
    assert lake.last_commit() == 1 and lake.read_log("raw_l", schemas.RAW_L).count() == 4
    land(root, "mumbai", "08", "a.json", GOOD % "z")  # mended
    again = snapshots.new_files(spark, str(root), lake.read_log("audit", schemas.AUDIT), region_level=2)
    assert sorted(r.path.split("/")[-2] for r in again.collect()) == ["08", "09"]
    raw, _ = snapshots.ingest_new(spark, str(root), lake.read_log("audit", schemas.AUDIT), NOW, region_level=2)
    assert {r.hex for r in raw.collect()} == {"z", "b"}


# ---- paging --------------------------------------------------------------------
@pytest.mark.parametrize("bounded", [False, True])
def test_pages_chained_give_the_whole_log(spark, tmp_path, bounded):
    rnd = random.Random(1)
    rows = [{"hex": rnd.choice("abc"), "region": "r", "ingested_at": T0 + rnd.randrange(9) * MIN, "gs_knots": 1.0 * rnd.randrange(2)} for _ in range(60)]
    log = serving.log_by_time(frame(spark, schemas.CLEAN_L, [*rows, {"hex": "z", "region": "r"}]))
    log.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    counts = marts.minute_metrics(log) if bounded else None
    cursor, seen = None, []
    while page := serving.page_after(log, cursor, 23, "r", counts).collect():
        seen += page
        cursor = (page[-1].ingested_at, page[-1].hex, page[-1].row_no)
    want = log.filter("ingested_at IS NOT NULL").orderBy(F.desc("ingested_at"), "hex", "row_no").collect()
    assert seen == want and len(seen) == 60


def test_a_page_is_bounded_in_the_scan(spark, tmp_path):
    log = serving.log_by_time(frame(spark, schemas.CLEAN_L, [{"hex": "a", "region": "r", "ingested_at": T0}]))
    log.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    try:
        page = serving.page_after(log, (NOW, "a", 1), 5, "r", marts.minute_metrics(log))
        plan = page._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(ingested_at" in plan and "TakeOrderedAndProject" in plan


# ---- change feed -----------------------------------------------------------------
def test_only_unequal_buckets_are_joined(spark, tmp_path):
    base = [{"hex": f"k{i}", "gs": 1.0 * i, "is_deleted": False} for i in range(60)]
    after = [dict(r, gs=99.0) if r["hex"] == "k5" else r for r in base if r["hex"] != "k9"] + [{"hex": "new", "is_deleted": False}]
    old, new = (parted.bucketed(spark, str(tmp_path / n), schemas.CURRENT_N, 32, "hex") for n in ("old", "new"))
    old.replace(frame(spark, schemas.CURRENT_N, base), 0)
    new.replace(frame(spark, schemas.CURRENT_N, after), 1)
    unequal = state.changed_buckets(old, new)
    assert set(unequal) == set(old.touched(frame(spark, schemas.CURRENT_N, [{"hex": h} for h in ("k5", "k9", "new")])))
    feed = state.change_feed_digest(old, new)
    assert rows_of(feed) == rows_of(state.change_feed(old.read(), new.read()))
    assert sorted(r._change_type for r in feed.collect()) == ["delete", "insert", "update_postimage", "update_preimage"]
    plan = state.change_feed(old.read(unequal), new.read(unequal))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [_part") == 2
    assert state.change_feed_digest(old, old).count() == 0


# ---- streams -----------------------------------------------------------------------
def test_late_rows_are_kept_apart_and_an_epoch_repeats(spark, raw_rows, tmp_path):
    lake, landing = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    for times in ((10, 30), (5, 25, 31), (40,)):
        raw_rows(*[{"fetched_at": T0 + t * MIN} for t in times], {"fetched_at": None}).coalesce(1).write.mode("append").parquet(landing)
        source = spark.readStream.schema(schemas.RAW_N).parquet(landing)
        feeds.write_with_late(source, lake, str(tmp_path / "progress"), lateness_minutes=10).awaitTermination()
    late = lake.read_log("late", schemas.RAW_N)
    assert [r.fetched_at for r in late.collect()] == [T0 + 5 * MIN]
    assert lake.read_log("on_time", schemas.RAW_N).count() == 8
    assert [r.operation_metrics for r in lake.commits().orderBy("version").collect()] == [
        '{"on_time_rows":3,"late_rows":0}', '{"on_time_rows":3,"late_rows":1}', '{"on_time_rows":2,"late_rows":0}',
    ]
    assert lake.read_state("newest", schemas.struct("newest TIMESTAMP")).first().newest == T0 + 40 * MIN


def test_a_better_row_replaces_the_first(spark, raw_rows, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    for seen in (None, 3.0, 0.5, 0.5):
        rows = raw_rows({"seen": seen, "gs": seen}).withColumn("ingestion_id", F.lit(f"id{seen}"))
        rows.write.mode("append").parquet(landing)
        best = feeds.best_rows(spark.readStream.schema(schemas.RAW_N).parquet(landing))
        feeds.write_newest(best, out, str(tmp_path / "progress")).awaitTermination()
    (row,) = feeds.read_newest(spark, out, best.schema, ["hex", "fetched_at"]).collect()
    assert (row.seen, row.gs, row.ingestion_id) == (0.5, 0.5, "id0.5")


def test_presence(spark):
    times = {"a": [0, 10, 39, 70, 200], "b": [5], "c": [0, 31]}
    rows = [{"hex": h, "ingested_at": T0 + t * MIN} for h, ts in times.items() for t in ts]
    log = frame(spark, schemas.CLEAN_L, [*rows, {"hex": None, "ingested_at": T0}, {"hex": "d"}])
    got = {(r.hex, (r.seen_from - T0) // MIN, (r.seen_to - T0) // MIN, r.observations) for r in feeds.presence_intervals(log).collect()}
    assert got == {("a", 0, 39, 3), ("a", 70, 70, 1), ("a", 200, 200, 1), ("b", 5, 5, 1), ("c", 0, 0, 1), ("c", 31, 31, 1)}
