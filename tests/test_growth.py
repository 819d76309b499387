"""What keeps the larger steps within their limits."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from contrail import registry, schemas
from contrail.plans import bitmaps, medallion, rollups
from contrail.sources.tables import Lake

T0 = datetime(2024, 1, 2)


def _events(spark, where, n=400):
    """A month of events on a few keys."""
    rows = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * (30 * 86400 // n)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") / 4).alias("value"),
        F.concat(F.lit('{"k": '), F.col("id") % 97, F.lit("}")).alias("props"),
    )
    rows.write.parquet(f"{where}/events.parquet")
    return str(where)


def test_a_day_of_documents_is_landed_by_several_tasks(spark, tmp_path):
    text = F.concat_ws("", *[F.sha2(F.concat("id", F.lit(i)), 256) for i in range(8)])
    docs = spark.range(0, 4000, 1, 8).select(
        F.element_at(F.array(F.lit("delhi"), F.lit("mumbai")), (F.col("id") % 2 + 1).cast("int")).alias("region"),
        text.alias("document"), F.lit("2024-01-02").alias("day"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "128k")
    try:
        registry._land(docs, str(tmp_path / "landing"))
    finally:
        spark.conf.unset(size)
    names = defaultdict(set)
    for file in (tmp_path / "landing").rglob("*.txt"):
        names[file.parent.parent.name].add(file.name)
    assert len(names["region=delhi"]) > 1
    assert names["region=delhi"] == names["region=mumbai"]
    assert spark.read.text(str(tmp_path / "landing")).count() == 4000


def test_sparse_buckets_hold_words_and_hash(spark, tmp_path):
    rows = [(f"k{i}", "AI1", "r", T0 + timedelta(minutes=i % 10), None, None, None, False) for i in range(300)]
    batch = spark.createDataFrame(
        rows, "hex string, flight string, region string, ingested_at timestamp, on_ground boolean, altitude_ft double, gs_knots double, is_emergency boolean"
    )
    store = bitmaps.Store(spark, str(tmp_path), "minute")
    bitmaps.fold(store, batch, 0)
    bits = store.bits.read()
    # A bucket never holds more than one word for each value it has seen.
    assert bits.groupBy("bucket", "kind").count().filter("count > 30").isEmpty()
    assert bits.schema["bits"].dataType.simpleString() == "bigint"
    assert sorted({r.unique_aircraft for r in bitmaps.minute_metrics(store).collect()}) == [30]
    plan = bitmaps.merge_bits(bits, bits)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_late_rules_share_the_first_batch(spark, tmp_path, monkeypatch):
    ran = []
    run = medallion.run_silver

    def counted(lake, raw, batch_id, *args, **options):
        ran.append((batch_id, options.get("late")))
        return run(lake, raw, batch_id, *args, **options)

    monkeypatch.setattr(medallion, "run_silver", counted)
    got = {r.late: r for r in registry.lake_late_rows(spark, _events(spark, tmp_path)).collect()}
    assert ran == [(0, None), (1, "drop"), (1, "keep"), (1, "quarantine")]
    late = {r.late_rows for r in got.values()}
    assert len(late) == 1 and late != {0}
    assert got["drop"].clean_rows == got["quarantine"].clean_rows < got["keep"].clean_rows == 400
    assert [got[n].quarantined for n in ("drop", "keep", "quarantine")] == [0, 0, late.pop()]


def test_first_marts_look_up_no_buckets(spark, tmp_path, raw_l_rows, monkeypatch):
    looked = []
    refresh = rollups.refresh_buckets

    def counted(known, clean, batch, unit, *args):
        looked.append(unit)
        return refresh(known, clean, batch, unit, *args)

    monkeypatch.setattr(rollups, "refresh_buckets", counted)
    lake = Lake(spark, str(tmp_path))
    for batch, hexes in enumerate(("a", "b")):
        raw = raw_l_rows({"hex": hexes, "_region": "r", "_ingested_at": T0 + timedelta(minutes=batch)})
        medallion.run_silver_local(lake, raw, batch, T0)
        medallion.update_gold_local(lake, T0)
        assert looked == (["minute", "hour"] if batch else [])
    assert lake.read_state("hourly_trend", schemas.struct("flight_count BIGINT")).first().flight_count == 2
    assert lake.read_state("minute_metrics", schemas.struct("metric_time TIMESTAMP")).count() == 2
