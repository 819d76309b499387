from __future__ import annotations

import json
from datetime import datetime

import pytest
from conftest import NOW

from contrail import schemas
from contrail.sources import regions, snapshots, tables
from contrail.streaming import feeds

POLLED_MS = 1780903677138  # 2026-06-08 07:27:57.138 UTC
PLANE = {
    "hex": "800c9b", "flight": "AI101   ", "r": "VT-ANF", "t": "B77W", "lat": 17.52, "lon": 78.91,
    "alt_baro": 34000, "gs": 480.0, "track": 245.0, "baro_rate": -64, "squawk": "2041",
    "category": "A5", "seen": 0.4, "messages": 120, "alert": 0, "spi": 0, "mlat": [],
    "nav_modes": ["autopilot"], "dbFlags": 1, "unlisted": {"deep": [1, 2.5]},
}
GROUND = {
    "hex": "a12345", "flight": "SG202   ", "r": "VT-SLB", "t": "B738", "lat": 18.1, "lon": 79.2,
    "alt_baro": "ground", "gs": "odd", "squawk": "7700", "emergency": "general",
}


def api(planes, **more):
    return {"now": POLLED_MS, "total": len(planes), "ac": planes, **more}


def enriched(planes):
    at = "2026-06-08T07:07:57.138318+00:00"
    stamp = {"_region": "delhi", "_region_label": "Delhi", "_ingested_at": at, "_source_url": "feed://x"}
    return {
        "region": "delhi", "region_label": "Delhi", "ingested_at": at, "api_url": "feed://x",
        "aircraft_count": len(planes), "aircraft": [{**p, **stamp} for p in planes],
    }


@pytest.fixture
def land(tmp_path):
    def write(name, doc, region="delhi"):
        folder = tmp_path / "raw" / region
        folder.mkdir(parents=True, exist_ok=True)
        text = doc if isinstance(doc, str) else json.dumps(doc, indent=2)
        (folder / name).write_text(text)
        return str(tmp_path / "raw")

    return write


def test_api_documents(spark, land):
    land("a.json", api([PLANE, GROUND, {"flight": "NOHEX"}, {"hex": ""}]))
    land("b.json", api([]))
    root = land("c.json", {"now": POLLED_MS}, region="mumbai")
    raw = snapshots.flatten_snapshots(snapshots.read_documents(spark, root), NOW)
    assert raw.columns == schemas.RAW_N.names
    rows = {r.hex: r for r in raw.collect()}
    assert set(rows) == {"800c9b", "a12345"}
    plane, ground = rows["800c9b"], rows["a12345"]
    assert plane.fetched_at == datetime(2026, 6, 8, 7, 27, 57)
    assert (plane.source_region, plane.flight, plane.alt_baro, plane.db_flags) == ("delhi", "AI101", 34000, 1)
    assert (ground.alt_baro, ground.gs, ground.emergency) == (None, None, "general")
    assert json.loads(plane.raw_payload) == PLANE
    assert json.loads(plane.nav_modes) == ["autopilot"] and plane._source_file.endswith("delhi/a.json")
    assert plane.ingestion_id != ground.ingestion_id


def test_missing_now_is_processing_time(spark, land):
    root = land("a.json", {"ac": [PLANE]})
    assert snapshots.flatten_snapshots(snapshots.read_documents(spark, root), NOW).first().fetched_at == NOW


def test_hash_ids_repeat(spark, land):
    root = land("a.json", api([PLANE, GROUND]))
    docs = snapshots.read_documents(spark, root)
    ids = [
        {r[0] for r in snapshots.flatten_snapshots(docs, NOW, ids="hash").select("ingestion_id").collect()}
        for _ in range(2)
    ]
    assert ids[0] == ids[1] and len(ids[0]) == 2


def test_enriched_documents(spark, land):
    root = land("delhi_1.json", enriched([PLANE, {**GROUND, "flight": None, "r": "", "alt_baro": None}]))
    raw = snapshots.flatten_enriched(snapshots.read_documents(spark, root), NOW)
    assert raw.columns == schemas.RAW_L.names
    rows = {r.hex: r for r in raw.collect()}
    plane, ground = rows["800c9b"], rows["a12345"]
    assert (plane.flight, plane.alt_baro, plane.messages, plane._region) == ("AI101", "34000", 120, "delhi")
    assert plane._ingested_at == datetime(2026, 6, 8, 7, 7, 57, 138318)
    assert (plane._source_file, plane._loaded_at) == ("delhi_1.json", NOW)
    assert json.loads(plane._raw_json)["hex"] == "800c9b"
    assert (ground.flight, ground.registration, ground.alt_baro) == (None, None, None)


def test_stamping_makes_enriched_documents(spark, land):
    root = land("a.json", api([PLANE, {}]))
    out = snapshots.enrich_documents(snapshots.read_documents(spark, root), "feed://v2/", "india", NOW).first()
    assert (out.region, out.region_label, out.aircraft_count) == ("delhi", "Delhi", 2)
    assert out.api_url == "feed://v2/lat/28.61/lon/77.2/dist/250"
    first, second = (json.loads(a) for a in out.aircraft)
    assert first["_region"] == second["_region"] == "delhi" and first["hex"] == "800c9b"
    assert first["_ingested_at"] == "2026-06-08T08:00:00+00:00"


def test_audit_and_incremental_load(spark, land):
    land("good.json", enriched([PLANE, GROUND]))
    land("empty.json", enriched([]))
    root = land("broken.json", '{"aircraft": [')
    none = spark.createDataFrame([], schemas.AUDIT)
    raw, audit = snapshots.ingest_new(spark, root, none, NOW)
    assert raw.count() == 2
    rows = {r.file_name: r for r in audit.collect()}
    assert (rows["good.json"].status, rows["good.json"].records_loaded) == ("OK", 2)
    assert (rows["empty.json"].status, rows["empty.json"].records_loaded) == ("OK", 0)
    assert rows["broken.json"].status == "ERROR" and rows["broken.json"].error_msg
    assert rows["good.json"].region == "delhi"
    land("later.json", enriched([PLANE]))
    again, _ = snapshots.ingest_new(spark, root, audit, NOW)
    assert {r[0] for r in again.select("_source_file").distinct().collect()} == {"later.json"}


def test_nothing_new(spark, land):
    root = land("good.json", enriched([PLANE]))
    audit = snapshots.audit_files(snapshots.read_documents(spark, root), NOW)
    raw, more = snapshots.ingest_new(spark, root, audit, NOW)
    assert (raw.count(), more.count()) == (0, 0)


def test_raw_landing_round_trip(spark, land):
    root = land("a.json", api([PLANE]))
    landed = snapshots.land_raw(spark, root, NOW)
    assert json.loads(landed.first().raw_json) == api([PLANE])
    from pyspark.sql import functions as F

    docs = snapshots.documents_from_text(landed, "raw_json", F.lit("/x/delhi/a.json"))
    assert snapshots.flatten_snapshots(docs, NOW).first().source_region == "delhi"


def test_stream_equals_batch(spark, land, tmp_path):
    land("a.json", api([PLANE, GROUND]))
    root = land("b.json", api([PLANE]), region="mumbai")
    columns = ["source_region", "hex", "fetched_at", "flight", "raw_payload"]
    stream = feeds.stream_snapshots(spark, f"{root}/*")
    feeds.write_parquet(stream.select(*columns), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(*columns).collect()))
    batch = snapshots.flatten_snapshots(snapshots.read_documents(spark, root), NOW)
    assert got == sorted(map(tuple, batch.select(*columns).collect())) and len(got) == 3


def test_rosters(spark):
    sizes = {name: regions.roster(spark, name).count() for name in regions.ROSTERS}
    assert sizes == {"world": 24, "india": 4, "india_first": 3}
    df = spark.createDataFrame([("new_york",), ("nowhere",)], "source_region string")
    rows = {r.source_region: r.label for r in regions.with_region(df, "source_region").collect()}
    assert rows == {"new_york": "New York", "nowhere": None}


def test_catalog_tables(spark):
    tables.ensure_tables(spark, "sky")
    tables.ensure_tables(spark, "sky")
    row = spark.createDataFrame([("{}", NOW)], schemas.LANDING)
    tables.append_table(row, "sky.adsb_raw")
    tables.append_table(row, "sky.adsb_raw")
    counts = {r.table_name: r.row_count for r in tables.layer_profile(spark, "sky").collect()}
    assert len(counts) == len(tables.CATALOG_TABLES) and counts["adsb_raw"] == 2
    tables.overwrite_table(row, "sky.adsb_raw")
    assert spark.table("sky.adsb_raw").count() == 1
    tables.truncate_table(spark, "sky.adsb_raw")
    assert spark.table("sky.adsb_raw").count() == 0
    assert tables.drop_layer(spark, "sky") == []
    assert len(tables.drop_layer(spark, "sky", confirm=True)) == len(tables.CATALOG_TABLES)
