"""Stored tables: versions per table, late rows, row ids, rows without a time."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from contrail import schemas, session
from contrail.operators import scd2
from contrail.plans import marts, medallion, rollups
from contrail.sources import snapshots
from contrail.sources.tables import Lake
from conftest import NOW, T0, frame


def keys(df):
    return sorted(r.hex for r in df.select("hex").collect())


def test_a_commit_of_another_profile_keeps_state(spark, raw_rows, raw_l_rows, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    medallion.run_silver(lake, raw_rows({"hex": "aaa111"}), 0, NOW)
    medallion.run_silver_local(lake, raw_l_rows({"hex": "bbb222"}), 1, NOW)
    assert keys(medallion.read_current(lake)) == ["aaa111"]
    later = raw_rows({"hex": "ccc333", "fetched_at": T0 + timedelta(minutes=1)})
    medallion.run_silver(lake, later, 2, NOW)
    assert keys(medallion.read_current(lake)) == ["aaa111", "ccc333"]
    assert keys(medallion.read_history(lake).filter("is_current")) == ["aaa111", "ccc333"]


def test_a_lost_folder_is_an_error(spark, raw_rows, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    medallion.run_silver(lake, raw_rows({}), 0, NOW)
    fs, where = lake._hadoop(f"{lake.path('current')}/version=0")
    fs.delete(where, True)
    with pytest.raises(FileNotFoundError):
        medallion.read_current(lake)


@pytest.mark.parametrize(("late", "clean", "aside"), [("drop", 1, 0), ("keep", 2, 0), ("quarantine", 1, 1)])
def test_late_rows_are_counted(spark, raw_rows, tmp_path, late, clean, aside):
    lake = Lake(spark, str(tmp_path / "lake"))
    medallion.run_silver(lake, raw_rows({"hex": "aaa111"}), 0, NOW)
    behind = raw_rows({"hex": "bbb222", "fetched_at": T0 - timedelta(minutes=1)})
    medallion.run_silver(lake, behind, 1, NOW, late=late)
    metrics = lake.commits().filter("version = 1").first().operation_metrics
    assert '"late_rows":1' in metrics
    assert lake.read_log("clean", medallion.CLEAN_N).count() == clean
    assert lake.read_log("late", schemas.RAW_N).count() == aside


def test_ids_are_unique_and_repeat(spark):
    text = '{"now": 1749366000000, "ac": [{"hex": "aaa111"}, {"hex": "aaa111"}]}'
    docs = snapshots.documents_from_text(spark.createDataFrame([(text,)] * 3, "t string"), "t", F.lit("/x/delhi/f.json"))
    ids = [r[0] for r in snapshots.flatten_snapshots(docs, NOW).select("ingestion_id").collect()]
    again = [r[0] for r in snapshots.flatten_snapshots(docs, NOW).select("ingestion_id").collect()]
    assert len(set(ids)) == 6 and sorted(ids) == sorted(again)


def test_equal_names_in_two_regions(spark, tmp_path):
    for region in ("delhi", "mumbai"):
        (tmp_path / region).mkdir()
        (tmp_path / region / "poll.json").write_text("{}")
    audit = frame(spark, schemas.AUDIT, [{"file_name": "poll.json", "region": "delhi", "status": "OK", "records_loaded": 1}])
    assert [r.region for r in snapshots.new_files(spark, str(tmp_path), audit).collect()] == ["mumbai"]


def test_rows_without_a_time_keep_their_bucket(spark):
    def rows(*times):
        made = [{"hex": f"a{i}", "region": "r", "ingested_at": t, "on_ground": False, "is_emergency": False} for i, t in enumerate(times)]
        return frame(spark, schemas.CLEAN_L, made)

    log, batch = rows(T0, None, None), rows(None)
    known = marts.minute_metrics(rows(T0, None))
    made = rollups.refresh_buckets(known, log, batch, "minute", "metric_time", marts.minute_metrics)
    want = marts.minute_metrics(log)
    assert sorted(map(str, made.collect())) == sorted(map(str, want.collect()))


def test_open_and_deleted_versions_stay(spark):
    history = frame(
        spark, schemas.HISTORY_N,
        [{"hex": "aaa111", "is_current": True, "is_deleted": True}, {"hex": "bbb222", "is_current": None}],
    )
    out = scd2.scd2_apply(history, frame(spark, schemas.CURRENT_N, []), "N", NOW)
    assert keys(out) == ["aaa111", "bbb222"]


def test_scratch_needs_a_shared_folder_off_local():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(Session(), "x")
