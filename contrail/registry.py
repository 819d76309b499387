"""The named queries: every operator over the given tables.

All read whole tables through :mod:`contrail.testbed`, which derives the
observations from ``events``. Times are fixed so that results repeat.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import schemas, testbed
from contrail.functions import columns as C
from contrail.functions.time import instant
from contrail.operators import cdc, clean, islands, keyed, lifecycle, scd2, state
from contrail.plans import bitmaps, kpis, marts, medallion, quality, rollups, serving
from contrail.session import scratch_path
from contrail.sources import parted, regions, snapshots, tables
from contrail.streaming import feeds

SPLIT = datetime(2024, 1, 16)
AS_OF = datetime(2024, 1, 31)
GRACE = 720  # minutes; polls of the test bed are an hour apart
WINDOW = 14400  # minutes
HOURS = 100
BATCH = timedelta(hours=36)

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared inputs -----------------------------------------------------------
def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return testbed.raw_n(testbed.read_events(spark, sf))


def _raw_l(spark: SparkSession, sf: str) -> DataFrame:
    return testbed.raw_l(testbed.read_events(spark, sf))


def _before(df: DataFrame, time: str = "fetched_at") -> DataFrame:
    return df.filter(F.col(time) < F.lit("2024-01-16").cast("timestamp"))


def _after(df: DataFrame, time: str = "fetched_at") -> DataFrame:
    return df.filter(F.col(time) >= F.lit("2024-01-16").cast("timestamp"))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_observations(_raw(spark, sf), "N", as_of=AS_OF)


def _clean_l(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_observations(_raw_l(spark, sf), "L")


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def _merged(spark: SparkSession, rows: DataFrame, as_of: datetime) -> DataFrame:
    first = _empty(spark, schemas.CURRENT_N)
    return state.merge_current(first, clean.latest_observation(rows), as_of=as_of)


def _state_1(spark: SparkSession, sf: str) -> DataFrame:
    """State after the first half, vanished keys flagged."""
    merged = _merged(spark, _before(_clean(spark, sf)), SPLIT)
    flagged = lifecycle.with_vanished(merged, _before(_raw(spark, sf)), GRACE)
    return state.set_flagged_deleted(flagged, "_gone", C.DISAPPEARED, SPLIT)


def _state(spark: SparkSession, sf: str) -> DataFrame:
    """State after everything in one batch, vanished keys flagged."""
    merged = _merged(spark, _clean(spark, sf), AS_OF)
    flagged = lifecycle.with_vanished(merged, _raw(spark, sf), GRACE)
    return state.set_flagged_deleted(flagged, "_gone", C.DISAPPEARED, AS_OF)


def _state_2(spark: SparkSession, sf: str) -> DataFrame:
    """State after both halves one by one: keys vanished at the split and, others, at the end."""
    raw = _after(_raw(spark, sf))
    woken = lifecycle.reactivate(_state_1(spark, sf), raw, AS_OF)[0]
    latest = clean.latest_observation(_after(_clean(spark, sf)))
    flagged = lifecycle.with_vanished(state.merge_current(woken, latest, as_of=AS_OF), raw, GRACE)
    return _stored(state.set_flagged_deleted(flagged, "_gone", C.DISAPPEARED, AS_OF), "state")


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Write an input that is read several times, as the layers do, and read it back."""
    where = scratch_path(df.sparkSession, label)
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def _stored_state(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(state, clean), both stored."""
    rows, raw = _stored(_clean(spark, sf), "clean"), _raw(spark, sf)
    flagged = lifecycle.with_vanished(_merged(spark, rows, AS_OF), raw, GRACE)
    current = state.set_flagged_deleted(flagged, "_gone", C.DISAPPEARED, AS_OF)
    return _stored(current, "state"), rows


def _no_cdc(spark: SparkSession) -> DataFrame:
    return _empty(spark, schemas.CDC_N)


def _marked(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = _clean(spark, sf)
    return lifecycle.mark_disappeared(
        _merged(spark, rows, AS_OF), _raw(spark, sf), rows, _no_cdc(spark), GRACE, as_of=AS_OF
    )


def _history(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored(_clean(spark, sf), "clean")
    first = scd2.scd2_apply(
        _empty(spark, schemas.HISTORY_N), _merged(spark, _before(rows), SPLIT), "N", SPLIT
    )
    return scd2.scd2_apply(first, _merged(spark, rows, AS_OF), "N", AS_OF)


def _history_l1(spark: SparkSession, sf: str) -> DataFrame:
    first = clean.latest_observation(_before(_clean_l(spark, sf), "ingested_at"), "L")
    return scd2.scd2_apply(_empty(spark, schemas.HISTORY_L), first, "L", SPLIT)


def _history_l(spark: SparkSession, sf: str) -> DataFrame:
    latest = clean.latest_observation(_clean_l(spark, sf), "L")
    return scd2.scd2_apply(_history_l1(spark, sf), latest, "L", AS_OF)


def _current_l(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.current_from_history(_history_l(spark, sf))


def _cdc_l(spark: SparkSession, sf: str) -> DataFrame:
    before = scd2.current_from_history(_history_l1(spark, sf))
    latest = clean.latest_observation(_clean_l(spark, sf), "L")
    return cdc.cdc_wide(before, latest, as_of=AS_OF)


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.kpi_snapshot(*_stored_state(spark, sf), AS_OF)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot documents written out as line-delimited files, read back as a source."""
    where = scratch_path(spark, "snapshots")
    docs = testbed.snapshot_documents(testbed.read_events(spark, sf))
    docs.write.partitionBy("region").text(where)
    return snapshots.read_documents(spark, where, multi_line=False, pattern="*.txt")


def _lake(spark: SparkSession, sf: str) -> tables.Lake:
    """Two batches through the stored silver layer."""
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    raw = _raw(spark, sf)
    medallion.run_silver(lake, _before(raw), 0, SPLIT, GRACE)
    medallion.run_silver(lake, _after(raw), 1, AS_OF, GRACE)
    return lake


def lake_mixed_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """The state of profile N where a batch of profile L was committed in between."""
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    raw = _raw(spark, sf)
    medallion.run_silver(lake, _before(raw), 0, SPLIT, GRACE)
    medallion.run_silver_local(lake, _raw_l(spark, sf), 1, SPLIT)
    medallion.run_silver(lake, _after(raw), 2, AS_OF, GRACE)
    return medallion.read_current(lake)


def lake_gold_after_gap(spark: SparkSession, sf: str) -> DataFrame:
    """Operator marts where the marts were left out for one commit."""
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    raw = _raw_l(spark, sf)
    first, rest = _before(raw, "_ingested_at"), _after(raw, "_ingested_at")
    later = F.pmod(F.xxhash64("hex"), F.lit(2)) == 0
    medallion.run_silver_local(lake, first, 0, SPLIT)
    medallion.update_gold_local(lake, SPLIT)
    medallion.run_silver_local(lake, rest.filter(later), 1, AS_OF)
    medallion.run_silver_local(lake, rest.filter(~later), 2, AS_OF)
    medallion.update_gold_local(lake, AS_OF)
    return lake.read_state("airline_dim", marts.airline_dim(_clean_l(spark, sf), AS_OF).schema)


def lake_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by what became of late ones: the newer half of the data comes first."""
    raw = _raw(spark, sf)
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    medallion.run_silver(lake, _after(raw), 0, SPLIT, GRACE)
    out = None
    # The second batch is run again for each rule; it starts from the first one's state and replaces its own folders.
    for late in ("drop", "keep", "quarantine"):
        medallion.run_silver(lake, _before(raw), 1, AS_OF, GRACE, late=late)
        metrics = F.from_json("operation_metrics", "late_rows BIGINT")["late_rows"]
        row = lake.commits().filter("version = 1").select(
            F.lit(late).alias("late"), metrics.alias("late_rows"),
            lake.read_log("clean", medallion.CLEAN_N).agg(F.count(F.lit(1)).alias("n")).scalar().alias("clean_rows"),
            lake.read_log("late", schemas.RAW_N).agg(F.count(F.lit(1)).alias("n")).scalar().alias("quarantined"),
        )
        row = _stored(row, "late")  # counted before the next run replaces what it counts
        out = row if out is None else out.unionByName(row)
    return out


def bucketed_current(spark: SparkSession, sf: str) -> DataFrame:
    """State in hash buckets after twenty batches of 36 hours, each stamped with its end."""
    rows = _stored(_clean(spark, sf), "clean")
    table = parted.bucketed(spark, scratch_path(spark, "state"), schemas.CURRENT_N, 8, "hex")
    for i in range(20):
        start = datetime(2024, 1, 1) + i * BATCH
        inside = (F.col("fetched_at") >= instant(start)) & (F.col("fetched_at") < instant(start + BATCH))
        state.merge_buckets(table, clean.latest_observation(rows.filter(inside)), i, start + BATCH)
    return table.read()


def _lake_routes(spark: SparkSession, sf: str) -> tables.Lake:
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    raw = _raw(spark, sf)
    for batch, (rows, at) in enumerate(((_before(raw), SPLIT), (_after(raw), AS_OF))):
        medallion.run_silver(lake, rows, batch, at, GRACE)
        medallion.update_gold(lake, at)
    return lake


def updated_routes(spark: SparkSession, sf: str) -> DataFrame:
    """Routes by signed deltas, where keys vanish after the first batch and return in the second."""
    return _lake_routes(spark, sf).read_log("route_summary", schemas.ROUTES_N).filter("batch_id = 1").drop("batch_id")


def updated_route_frequency(spark: SparkSession, sf: str) -> DataFrame:
    metrics = _lake_routes(spark, sf).read_log("metrics", schemas.METRICS_N)
    return metrics.filter("batch_id = 1 AND metric_name = 'route_frequency'").drop("batch_id", "snapshot_at")


def event_suppression_stored(spark: SparkSession, sf: str) -> DataFrame:
    """DISAPPEARED events of two batches, none twice for a key; the state remembers what was logged."""
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    raw = _raw(spark, sf)
    for batch, (rows, at) in enumerate(((_before(raw), SPLIT), (_after(raw), AS_OF))):
        medallion.run_silver(lake, rows, batch, at, GRACE, suppress_minutes=60 * 24 * 60)
    events = lake.read_log("cdc", schemas.CDC_N).filter("change_type = 'DISAPPEARED'")
    return events.select("hex", "callsign", "old_value", "event_at", "detected_at")


class _Stopping(tables.Lake):
    """A store whose writes of state stop after so many, as if the run had died."""

    def __init__(self, spark: SparkSession, root: str, writes: int):
        super().__init__(spark, root)
        self.left = writes

    def write_state(self, table: str, df: DataFrame, version: int) -> None:
        if not self.left:
            raise InterruptedError(table)
        self.left -= 1
        super().write_state(table, df, version)


def lake_gold_after_crash(spark: SparkSession, sf: str) -> DataFrame:
    """One measure per row of all seven marts, after a run of the marts that died half way and one more batch."""
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    raw = _raw_l(spark, sf)
    first, rest = _before(raw, "_ingested_at"), _after(raw, "_ingested_at")
    medallion.run_silver_local(lake, first, 0, SPLIT)
    try:
        medallion.update_gold_local(_Stopping(spark, lake.root, 4), SPLIT)
    except InterruptedError:
        pass
    medallion.run_silver_local(lake, rest, 1, AS_OF)
    medallion.update_gold_local(lake, AS_OF)
    made = medallion.gold_l(_current_l(spark, sf), _clean_l(spark, sf), AS_OF)
    out = None
    for mart, (keys, measures) in _MEASURED.items():
        rows = lake.read_state(mart, made[mart].schema)
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys.split()])
        value = sum((F.coalesce(F.col(m).cast("double"), F.lit(0.0)) for m in measures.split()), F.lit(0.0))
        part = rows.select(F.lit(mart).alias("mart"), key.alias("key"), value.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


_MEASURED = {
    "aircraft_dim": ("hex first_seen last_seen", "total_observations"),
    "airline_dim": ("callsign_prefix last_seen", "flight_count avg_altitude_ft"),
    "minute_metrics": ("metric_time region", "total_flights on_ground airborne unique_aircraft unique_airlines"),
    "kpis": ("kpi_name kpi_label", "kpi_value"),
    "region_summary": ("region top_aircraft_type", "total_flights emergency_count"),
    "top_operators": ("operator rank", "flight_count"),
    "hourly_trend": ("hour_bucket region", "flight_count emergency_count"),
}


def _lake_l(spark: SparkSession, sf: str) -> tables.Lake:
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    raw = _raw_l(spark, sf)
    medallion.run_silver_local(lake, _before(raw, "_ingested_at"), 0, SPLIT)
    medallion.run_silver_local(lake, _after(raw, "_ingested_at"), 1, AS_OF)
    return lake


# ---- sources -----------------------------------------------------------------
_INGESTED = (
    "source_region fetched_at hex flight lat lon alt_baro gs track baro_rate squawk emergency "
    "registration aircraft_type category seen db_flags"
).split()
_ENRICHED = (
    "hex flight registration aircraft_type squawk category lat lon alt_baro gs track baro_rate "
    "seen emergency _region _region_label _ingested_at _source_url"
).split()


def ingest_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.flatten_snapshots(_documents(spark, sf), AS_OF).select(*_INGESTED)


def ingest_enriched(spark: SparkSession, sf: str) -> DataFrame:
    docs = testbed.snapshot_documents(testbed.read_events(spark, sf))
    parsed = snapshots.documents_from_text(
        docs, "document", F.concat(F.col("region"), F.lit("/landed.json"))
    )
    enriched = snapshots.enrich_documents(parsed, "feed://v2", "india", AS_OF)
    enriched = enriched.withColumn("ac", F.lit(None).cast("array<string>")).withColumn(
        "_file_name", F.lit("landed.json")
    )
    return snapshots.flatten_enriched(enriched, AS_OF).select(*_ENRICHED)


def ingest_audit(spark: SparkSession, sf: str) -> DataFrame:
    audit = snapshots.audit_files(_documents(spark, sf), AS_OF)
    return audit.groupBy("region", "status").agg(
        F.sum("records_loaded").alias("records_loaded"), F.max("loaded_at").alias("loaded_at")
    )


def empty_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and rows per region, where every region also sent an empty array and none at all."""
    docs = testbed.snapshot_documents(testbed.read_events(spark, sf))
    for text in ('{"now": 1704067200000, "total": 0, "ac": []}', '{"now": 1704067200000}'):
        docs = docs.unionByName(docs.select("region", F.lit(text).alias("document")).distinct())
    parsed = snapshots.documents_from_text(docs, "document", F.concat(F.lit("/landing/"), "region", F.lit("/polls.json")))
    rows = snapshots.flatten_snapshots(parsed, AS_OF).groupBy(F.col("source_region").alias("region")).agg(
        F.count(F.lit(1)).alias("raw_rows")
    )
    counted = parsed.groupBy(F.col("_folder").alias("region")).agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.size(F.coalesce("ac", F.array().cast("array<string>"))) == 0).alias("empty")
    )
    return counted.join(rows, "region")


def table_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog tables made twice, filled, emptied and dropped: their number and rows after each step."""
    database = f"contrail_{uuid.uuid4().hex[:12]}"
    steps = []

    def note(step: str) -> None:
        profile = tables.layer_profile(spark, database)
        steps.append((step, *profile.agg(F.count(F.lit(1)), F.coalesce(F.sum("row_count"), F.lit(0))).first()))

    tables.ensure_tables(spark, database)
    note("created")
    tables.append_table(_clean(spark, sf), f"{database}.flight_clean")
    tables.append_table(_no_cdc(spark), f"{database}.flight_cdc")
    tables.ensure_tables(spark, database)
    note("filled")
    tables.overwrite_table(_before(_clean(spark, sf)), f"{database}.flight_clean")
    note("overwritten")
    tables.truncate_table(spark, f"{database}.flight_clean")
    note("emptied")
    tables.drop_layer(spark, database)
    note("not confirmed")
    tables.drop_layer(spark, database, confirm=True)
    note("dropped")
    spark.sql(f"DROP SCHEMA {database}")
    return spark.createDataFrame(steps, "step STRING, tables BIGINT, rows BIGINT")


def raw_landing(spark: SparkSession, sf: str) -> DataFrame:
    where = scratch_path(spark, "landing")
    testbed.snapshot_documents(testbed.read_events(spark, sf)).write.partitionBy("region").text(where)
    landed = snapshots.land_raw(spark, where, AS_OF, per_line=True)
    return landed.groupBy("ingestion_time").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(F.get_json_object("raw_json", "$.total").cast("bigint")).alias("elements"),
    )


def region_lookup(spark: SparkSession, sf: str) -> DataFrame:
    counts = quality.region_profile(_raw(spark, sf)).select("source_region", "row_count")
    return regions.with_region(counts, "source_region", "india")


# ---- cleaning ----------------------------------------------------------------
def incremental_clean(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf)
    done = clean.clean_observations(_before(raw), "N", as_of=SPLIT)
    return clean.clean_observations(raw, "N", clean.high_water_mark(done), AS_OF)


def dedup_rank(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.flag_duplicates(_raw(spark, sf)).select(
        "ingestion_id", "hex", "fetched_at", "is_duplicate"
    )


def dq_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = ["dq_missing_pos", "dq_missing_call", "dq_bad_alt", "dq_bad_speed"]
    return _clean_l(spark, sf).groupBy(*flags).agg(F.count(F.lit(1)).alias("rows"))


def new_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of keys unknown to the clean rows of one region."""
    rows = _clean_l(spark, sf)
    return clean.new_keys_only(rows, rows.filter("region = 'delhi' AND on_ground")).select(
        "hex", "flight", "ingested_at", "region"
    )


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Declared emergencies get their time in the wrong unit and are set apart again."""
    wrong = F.timestamp_seconds(F.unix_millis("fetched_at"))
    raw = _raw(spark, sf).withColumn(
        "fetched_at",
        F.when(F.col("emergency") == "general", wrong).otherwise(F.col("fetched_at")),
    )
    usable, corrupt = clean.quarantine(raw)
    label = F.lit("usable").alias("kind"), F.lit("corrupt").alias("kind")
    counts = [
        df.groupBy(kind, "source_region").agg(F.count(F.lit(1)).alias("rows"))
        for df, kind in zip((usable, corrupt), label)
    ]
    return counts[0].unionByName(counts[1])


# ---- keys and state ----------------------------------------------------------
def latest_two(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.live(_clean(spark, sf))
    order = [F.desc("fetched_at"), F.col("ingestion_id")]
    return keyed.top_per_key(rows, ["hex"], order, 2).select("hex", "fetched_at", "callsign", "rn")


def merge_current(spark: SparkSession, sf: str) -> DataFrame:
    rows = _clean(spark, sf)
    second = clean.latest_observation(_after(rows))
    return state.merge_current(_state_1(spark, sf), second, as_of=AS_OF)


def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    rows = _clean(spark, sf)
    before = _stored(_state_1(spark, sf), "state")
    merged = state.merge_current(before, clean.latest_observation(_after(rows)), as_of=AS_OF)
    return state.change_feed(before, clean.live(merged)).select(
        "hex", "callsign", "lat", "lon", "last_seen_at", "is_deleted", "_change_type"
    )


def change_feed_digest(spark: SparkSession, sf: str) -> DataFrame:
    """The same feed from two versions in hash buckets, joined only where their digests differ."""
    rows = _clean(spark, sf)
    old, new = (parted.bucketed(spark, scratch_path(spark, n), schemas.CURRENT_N, 16, "hex") for n in ("old", "new"))
    old.replace(_state_1(spark, sf), 0)
    merged = state.merge_current(old.read(), clean.latest_observation(_after(rows)), as_of=AS_OF)
    new.replace(clean.live(merged), 1)
    return state.change_feed_digest(old, new).select(
        "hex", "callsign", "lat", "lon", "last_seen_at", "is_deleted", "_change_type"
    )


def page_after(spark: SparkSession, sf: str) -> DataFrame:
    """The third page of fifty rows, reached by cursors."""
    rows = _clean_l(spark, sf)
    log, counts = _stored(serving.log_by_time(rows), "log"), _stored(marts.minute_metrics(rows), "minutes")
    cursor = None
    for _ in range(2):
        last = serving.page_after(log, cursor, 50, "mumbai", counts).orderBy("ingested_at", F.desc("hex"), F.desc("row_no")).first()
        cursor = (last.ingested_at, last.hex, last.row_no) if last else cursor
    return serving.page_after(log, cursor, 50, "mumbai", counts).drop("row_no")


def _some_keys(df: DataFrame) -> DataFrame:
    """Keys with an emergency in the state."""
    return df.filter("is_emergency").select("hex")


def soft_delete_state(spark: SparkSession, sf: str) -> DataFrame:
    current = _stored(_state(spark, sf), "state")
    return state.soft_delete(current, _history(spark, sf), _some_keys(current), "MANUAL", AS_OF)[0]


def soft_delete_history(spark: SparkSession, sf: str) -> DataFrame:
    current = _stored(_state(spark, sf), "state")
    history = state.soft_delete(current, _history(spark, sf), _some_keys(current), "MANUAL", AS_OF)[1]
    return history.drop("flight_sk")


def restore_state(spark: SparkSession, sf: str) -> DataFrame:
    current = _stored(_state(spark, sf), "state")
    return state.restore(current, _some_keys(current), AS_OF)


def disappeared_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _marked(spark, sf)[1].groupBy("hex", "is_deleted", "deleted_reason").agg(
        F.count(F.lit(1)).alias("rows"), F.max("deleted_at").alias("deleted_at")
    )


def vanished_at_once(spark: SparkSession, sf: str) -> DataFrame:
    """The older rule: every live key that the newest poll does not have, without a grace period."""
    return lifecycle.vanished(_stored(_merged(spark, _clean(spark, sf), AS_OF), "state"), _raw(spark, sf), 0)


def event_suppression(spark: SparkSession, sf: str) -> DataFrame:
    """The events again, once those of live-emergency keys count as logged already."""
    raw = _raw(spark, sf)
    merged = _stored(_merged(spark, _clean(spark, sf), AS_OF), "state")
    gone = lifecycle.vanished(merged, raw, GRACE)
    events = lifecycle.vanish_events(gone, raw, _no_cdc(spark), as_of=AS_OF)
    logged = events.join(_some_keys(merged), "hex", "left_semi")
    return lifecycle.vanish_events(gone, raw, logged, as_of=AS_OF)


def reactivated_state(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.reactivate(_state_1(spark, sf), _after(_raw(spark, sf)), AS_OF)[0]


def reactivated_events(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.reactivate(_state_1(spark, sf), _after(_raw(spark, sf)), AS_OF)[1]


def by_minute(spark: SparkSession, sf: str) -> DataFrame:
    """Events stamped with the hour each key was last seen."""
    raw = _raw(spark, sf)
    merged = _stored(_merged(spark, _clean(spark, sf), AS_OF), "state")
    flagged = lifecycle.with_vanished(merged, raw, GRACE)
    current = state.set_flagged_deleted(flagged, "_gone", C.DISAPPEARED, AS_OF)
    gone = lifecycle.vanished(merged, raw, GRACE)
    events = lifecycle.vanish_events(gone, raw, _no_cdc(spark), as_of=AS_OF)
    at_last_seen = events.withColumn("detected_at", F.col("event_at"))
    return lifecycle.disappearance_by_minute(at_last_seen, current, WINDOW, AS_OF)


# ---- events and versions -----------------------------------------------------
def cdc_since(spark: SparkSession, sf: str) -> DataFrame:
    """Only events newer than those of the first half, in compass degrees."""
    rows = _clean(spark, sf)
    logged = cdc.cdc_long(_before(rows), as_of=SPLIT)
    return cdc.cdc_long(rows, since=cdc.cdc_mark(logged), as_of=AS_OF, wrap_heading=True)


def scd2_not_null_safe(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored(_clean(spark, sf), "clean")
    first = scd2.scd2_apply(
        _empty(spark, schemas.HISTORY_N), _merged(spark, _before(rows), SPLIT), "N", SPLIT
    )
    after = _merged(spark, rows, AS_OF)
    return scd2.scd2_apply(first, after, "N", AS_OF, null_safe=False).drop("flight_sk")


# ---- stored layers and streams -----------------------------------------------
def lake_current(spark: SparkSession, sf: str) -> DataFrame:
    return medallion.read_current(_lake(spark, sf))


def lake_clean(spark: SparkSession, sf: str) -> DataFrame:
    return medallion.read_clean(_lake(spark, sf)).groupBy("hex", "is_deleted", "deleted_reason").agg(
        F.count(F.lit(1)).alias("rows"), F.max("deleted_at").alias("deleted_at")
    )


def lake_history(spark: SparkSession, sf: str) -> DataFrame:
    return medallion.read_history(_lake(spark, sf)).drop("flight_sk")


def lake_events(spark: SparkSession, sf: str) -> DataFrame:
    return serving.event_counts(_lake(spark, sf).read_log("cdc", schemas.CDC_N), "change_type")


def lake_local_history(spark: SparkSession, sf: str) -> DataFrame:
    history = medallion.read_history(_lake_l(spark, sf), "history_l", schemas.HISTORY_L)
    return history.select("hex", "effective_from", "effective_to", "is_current", "change_reason")


def commit_history(spark: SparkSession, sf: str) -> DataFrame:
    commits = tables.commit_history(_lake(spark, sf).commits())
    metrics = F.from_json("operation_metrics", "total BIGINT, duplicates BIGINT")
    return commits.select("version", "committed_at", "operation", metrics.alias("m")).select(
        "version", "committed_at", "operation", "m.total", "m.duplicates"
    )


def layer_profile(spark: SparkSession, sf: str) -> DataFrame:
    current, rows = _stored_state(spark, sf)
    history = _history(spark, sf)
    return tables.table_profile(
        {"raw": _raw(spark, sf), "clean": rows, "current": current, "history": history}
    )


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The table as a stream; as a glob the path may be a file or a folder."""
    schema = testbed.read_events(spark, sf).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")


def _run_stream(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-progress")
    schema = df.schema
    feeds.write_parquet(df, out, checkpoint).awaitTermination()
    return spark.read.schema(schema).parquet(out)


def _streamed_buckets(spark: SparkSession, sf: str, unit: str) -> bitmaps.Store:
    """The whole stream folded into bitmap marts, open windows and late rows too."""
    store = bitmaps.Store(spark, scratch_path(spark, "marts"), unit)
    rows = feeds.clean_stream(testbed.raw_l(_event_stream(spark, sf)))
    feeds.write_buckets(rows, store, scratch_path(spark, "progress")).awaitTermination()
    return store


def stream_minute_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.minute_metrics(_streamed_buckets(spark, sf, "minute"))


def stream_hourly_trend(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.hourly_trend(_streamed_buckets(spark, sf, "hour"))


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    unique = feeds.drop_repeats(testbed.raw_n(_event_stream(spark, sf)))
    return _run_stream(unique.select("hex", "fetched_at"), "unique")


def stream_silver(spark: SparkSession, sf: str) -> DataFrame:
    """The two halves landed one after the other, each run to the end of the stream."""
    landing = scratch_path(spark, "landing")
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    checkpoint = scratch_path(spark, "progress")
    raw = _raw(spark, sf)
    for half, now in ((_before(raw), SPLIT), (_after(raw), AS_OF)):
        half.write.mode("append").parquet(landing)
        source = spark.readStream.schema(schemas.RAW_N).parquet(landing)
        feeds.write_silver(
            source, lake, checkpoint, clock=lambda now=now: now, grace_minutes=GRACE
        ).awaitTermination()
    return medallion.read_current(lake)


def stream_dedup_best(spark: SparkSession, sf: str) -> DataFrame:
    """The best row per key and poll, read from a stream of several micro-batches."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "best")
    _raw(spark, sf).repartition(4).write.parquet(landing)
    source = spark.readStream.schema(schemas.RAW_N).option("maxFilesPerTrigger", 2).parquet(landing)
    # The newest poll comes in any file, so nothing may count as late.
    best = feeds.best_rows(source, lateness="365 days").select("hex", "fetched_at", "ingestion_id", "seen", "lat", "gs")
    feeds.write_newest(best, out, scratch_path(spark, "progress")).awaitTermination()
    return feeds.read_newest(spark, out, best.schema, ["hex", "fetched_at"])


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The newer half lands first; of the older half, rows behind by more than twenty days are late."""
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    raw = _raw(spark, sf)
    for half in (_after(raw), _before(raw)):
        half.write.mode("append").parquet(landing)
        source = spark.readStream.schema(schemas.RAW_N).parquet(landing)
        feeds.write_with_late(source, lake, checkpoint, lateness_minutes=20 * 24 * 60).awaitTermination()
    metrics = F.from_json("operation_metrics", "on_time_rows BIGINT, late_rows BIGINT")
    counted = lake.commits().select(F.col("version").alias("epoch"), metrics.alias("m")).select("epoch", "m.*")
    logs = [lake.read_log(n, schemas.RAW_N).groupBy("batch_id").agg(F.count(F.lit(1)).alias(f"{n}_stored")) for n in ("on_time", "late")]
    for log in logs:
        counted = counted.join(log.withColumnRenamed("batch_id", "epoch"), "epoch", "left")
    return counted.fillna(0)


def presence_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.presence_intervals(_clean_l(spark, sf), "12 hours")


def stream_presence(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a stream; a later heartbeat of a key of its own lets the last stretches end."""
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "presence", "progress"))
    rows = _clean_l(spark, sf)
    beat = rows.agg((F.max("ingested_at") + F.expr("INTERVAL 2 DAYS")).alias("ingested_at")).withColumn("hex", F.lit("heartbeat"))
    for part in (rows.select("ingested_at", "hex"), beat):
        part.write.mode("append").parquet(landing)
        source = spark.readStream.schema("ingested_at TIMESTAMP, hex STRING").parquet(landing)
        found = feeds.presence_intervals(source, "12 hours")
        feeds.write_parquet(found, out, checkpoint).awaitTermination()
    return spark.read.schema(found.schema).parquet(out).filter("hex <> 'heartbeat'")


def _land(docs: DataFrame, landing: str) -> None:
    """Append documents below ``region=/day=``; a day is dealt evenly over tasks, each of which names its files alike in all regions."""
    docs.hint("rebalance", "day").write.mode("append").partitionBy("region", "day").text(landing)


def ingest_new_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of the intake: half of the documents, nothing new, the rest with a malformed file.

    Documents lie two levels below the landing folder, under equal file names in all regions.
    """
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    lake = tables.Lake(spark, scratch_path(spark, "lake"))
    polled = F.timestamp_millis(F.get_json_object("document", "$.now").cast("bigint"))
    docs = testbed.snapshot_documents(testbed.read_events(spark, sf)).withColumn("day", F.date_format(polled, "yyyy-MM-dd"))
    docs = _stored(docs.withColumn("first", polled < instant(SPLIT)), "documents")
    broken = docs.limit(1).select(F.lit("delhi").alias("region"), F.lit('{"now": 1, "ac": [').alias("document"), F.lit("broken").alias("day"))
    rest = docs.filter("NOT first").drop("first").unionByName(broken)
    for landed in (docs.filter("first").drop("first"), None, rest):
        if landed is not None:
            _land(landed, landing)
        snapshots.ingest_stream(
            spark, landing, lake, checkpoint, "N", multi_line=False, pattern="*.txt", region_level=2, clock=lambda: AS_OF
        ).awaitTermination()
    audit = lake.read_log("audit", schemas.AUDIT).groupBy(F.col("batch_id").alias("epoch"), "region", "status").agg(
        F.sum("records_loaded").alias("records_loaded"), F.count_if(F.col("error_msg").isNotNull()).alias("failed")
    )
    loaded = lake.read_log("raw", schemas.RAW_N).groupBy(F.col("batch_id").alias("epoch"), F.col("source_region").alias("region")).agg(
        F.count(F.lit(1)).alias("raw_rows")
    )
    return audit.join(loaded.withColumn("status", F.lit("OK")), ["epoch", "region", "status"], "left").fillna(0, ["raw_rows"])


# ---- marts kept up to date ---------------------------------------------------
def _halves_l(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all, first, second) clean rows, parted within a minute so that buckets overlap."""
    rows = _clean_l(spark, sf)
    parted = F.col("ingested_at") < F.lit("2024-01-16 12:30:30").cast("timestamp")
    return rows, rows.filter(parted), rows.filter(~parted)


def updated_aircraft(spark: SparkSession, sf: str) -> DataFrame:
    _, first, second = _halves_l(spark, sf)
    known = rollups.merge_aircraft(_empty(spark, rollups.AIRCRAFT), first)
    return rollups.aircraft_dim(rollups.merge_aircraft(known, second), AS_OF)


def updated_airlines(spark: SparkSession, sf: str) -> DataFrame:
    _, first, second = _halves_l(spark, sf)
    known = rollups.merge_operators(_empty(spark, rollups.OPERATORS), first)
    return rollups.airline_dim(rollups.merge_operators(known, second), AS_OF)


def updated_regions(spark: SparkSession, sf: str) -> DataFrame:
    _, first, second = _halves_l(spark, sf)
    counts = rollups.merge_types(rollups.merge_types(_empty(spark, rollups.TYPES), first), second)
    return marts.region_summary_of(_current_l(spark, sf), counts, AS_OF)


def updated_minutes(spark: SparkSession, sf: str) -> DataFrame:
    rows, first, second = _halves_l(spark, sf)
    known = marts.minute_metrics(first)
    return rollups.refresh_buckets(
        known, rows, second, "minute", "metric_time", marts.minute_metrics
    )


def updated_hours(spark: SparkSession, sf: str) -> DataFrame:
    rows, first, second = _halves_l(spark, sf)
    known = marts.hourly_trend(first)
    return rollups.refresh_buckets(known, rows, second, "hour", "hour_bucket", marts.hourly_trend)


def _folded(spark: SparkSession, sf: str, unit: str) -> bitmaps.Store:
    """Two batches that share minutes; the newer one comes first."""
    _, first, second = _halves_l(spark, sf)
    store = bitmaps.Store(spark, scratch_path(spark, "marts"), unit)
    for batch, rows in enumerate((second, first)):
        bitmaps.fold(store, rows, batch)
    return store


def bitmap_minutes(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.minute_metrics(_folded(spark, sf, "minute"))


def bitmap_hours(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.hourly_trend(_folded(spark, sf, "hour"))


# ---- every change of a log ---------------------------------------------------
def scd2_from_log(spark: SparkSession, sf: str) -> DataFrame:
    return islands.scd2_from_log(_clean(spark, sf))


def scd2_from_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The open versions of the first half gone on with by the second."""
    rows = _stored(_clean(spark, sf), "clean")
    first = _stored(islands.scd2_from_log(_before(rows)), "versions")
    second = islands.scd2_from_log(_after(rows), opened=first.filter("is_current"))
    return first.filter("NOT is_current").unionByName(second).drop("version", "change_reason")


def cdc_from_log(spark: SparkSession, sf: str) -> DataFrame:
    return islands.cdc_from_log(_clean(spark, sf), as_of=AS_OF)


# ---- the registry ------------------------------------------------------------
def _on(make: Callable, *inputs: Callable, **params) -> Query:
    """A query that applies ``make`` to the named inputs."""
    return lambda spark, sf: make(*[given(spark, sf) for given in inputs], **params)


def _aircraft_dim(spark: SparkSession, sf: str) -> DataFrame:
    return marts.aircraft_dim(_clean_l(spark, sf), AS_OF)


def _airline_dim(spark: SparkSession, sf: str) -> DataFrame:
    return marts.airline_dim(_clean_l(spark, sf), AS_OF)


def _minutes(spark: SparkSession, sf: str) -> DataFrame:
    return marts.minute_metrics(_clean_l(spark, sf))


def _trend(spark: SparkSession, sf: str) -> DataFrame:
    return marts.hourly_trend(_clean_l(spark, sf))


def _kpis_l(spark: SparkSession, sf: str) -> DataFrame:
    return marts.kpis(_current_l(spark, sf), AS_OF)


def _region_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.region_summary(_current_l(spark, sf), _clean_l(spark, sf), AS_OF)


def _top_operators(spark: SparkSession, sf: str) -> DataFrame:
    return marts.top_operators(_clean_l(spark, sf), as_of=AS_OF)


def _routes(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.route_summary(_clean(spark, sf), AS_OF)


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.hotspots(_state(spark, sf), as_of=AS_OF)


def hotspots(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: events -> clean -> state -> live keys per grid cell."""
    return _cells(spark, sf)


QUERIES: dict[str, Query] = {
    # sources
    "ingest_snapshots": ingest_snapshots,
    "ingest_enriched": ingest_enriched,
    "ingest_audit": ingest_audit,
    "ingest_new_rounds": ingest_new_rounds,
    "raw_landing": raw_landing,
    "empty_documents": empty_documents,
    "table_cycle": table_cycle,
    "region_lookup": region_lookup,
    # cleaning
    "clean_n": _clean,
    "clean_l": _clean_l,
    "incremental_clean": incremental_clean,
    "dedup_rank": dedup_rank,
    "dq_flags": dq_flags,
    "new_keys": new_keys,
    "quarantine": quarantine,
    "load_stats": _on(clean.load_stats, _clean),
    # keys and state
    "latest_per_key": _on(clean.latest_observation, _clean),
    "latest_per_key_l": _on(clean.latest_observation, _clean_l, profile="L"),
    "latest_two": latest_two,
    "merge_current": merge_current,
    "change_feed": change_feed,
    "change_feed_digest": change_feed_digest,
    "soft_delete_state": soft_delete_state,
    "soft_delete_history": soft_delete_history,
    "restore_state": restore_state,
    "soft_deleted": _on(state.soft_deleted, _state),
    # lifecycle
    "disappeared_state": lambda s, sf: _marked(s, sf)[0],
    "disappeared_clean": disappeared_clean,
    "disappeared_events": lambda s, sf: _marked(s, sf)[2],
    "event_suppression": event_suppression,
    "reactivated_state": reactivated_state,
    "reactivated_events": reactivated_events,
    "disappearance_rate": _on(lifecycle.disappearance_rate, _state_2, minutes=WINDOW, as_of=AS_OF),
    "disappearance_by_minute": by_minute,
    "disappeared_since": _on(lifecycle.disappeared_since, _state_2, as_of=AS_OF),
    "vanished_at_once": vanished_at_once,
    # events and versions
    "cdc_long": _on(cdc.cdc_long, _clean, as_of=AS_OF),
    "cdc_since": cdc_since,
    "cdc_wide": _cdc_l,
    "scd2_n": lambda s, sf: _history(s, sf).drop("flight_sk"),
    "scd2_not_null_safe": scd2_not_null_safe,
    "scd2_l": _history_l,
    "scd2_from_log": scd2_from_log,
    "scd2_from_batches": scd2_from_batches,
    "cdc_from_log": cdc_from_log,
    "current_from_history": _current_l,
    # stored layers and streams
    "lake_current": lake_current,
    "lake_clean": lake_clean,
    "lake_history": lake_history,
    "lake_events": lake_events,
    "lake_local_history": lake_local_history,
    "commit_history": commit_history,
    "lake_mixed_profiles": lake_mixed_profiles,
    "lake_gold_after_gap": lake_gold_after_gap,
    "lake_late_rows": lake_late_rows,
    "lake_gold_after_crash": lake_gold_after_crash,
    "bucketed_current": bucketed_current,
    "event_suppression_stored": event_suppression_stored,
    "layer_profile": layer_profile,
    "stream_minute_metrics": stream_minute_metrics,
    "stream_hourly_trend": stream_hourly_trend,
    "stream_dedup": stream_dedup,
    "stream_silver": stream_silver,
    "stream_dedup_best": stream_dedup_best,
    "stream_late_rows": stream_late_rows,
    "presence_intervals": presence_intervals,
    "stream_presence": stream_presence,
    # KPIs and marts
    "kpi_scalar": _on(kpis.scalar_kpis, _state),
    "kpi_grouped": lambda s, sf: kpis.grouped_kpis(*_stored_state(s, sf)),
    "kpi_snapshot": _metrics,
    "route_frequency": _on(kpis.route_frequency, _clean),
    "route_summary": _routes,
    "hotspots": hotspots,
    "aircraft_dim": _aircraft_dim,
    "airline_dim": _airline_dim,
    "minute_metrics": _minutes,
    "kpis_unpivot": _kpis_l,
    "region_summary": _region_summary,
    "top_operators": _top_operators,
    "hourly_trend": _trend,
    "updated_aircraft": updated_aircraft,
    "updated_airlines": updated_airlines,
    "updated_regions": updated_regions,
    "updated_minutes": updated_minutes,
    "updated_hours": updated_hours,
    "bitmap_minutes": bitmap_minutes,
    "bitmap_hours": bitmap_hours,
    "updated_routes": updated_routes,
    "updated_route_frequency": updated_route_frequency,
    # query library
    "live_flights": _on(serving.live_flights, _current_l, region="delhi", airborne_only=True),
    "live_emergencies": _on(serving.live_flights, _current_l, emergency_only=True),
    "page_clean": _on(serving.page_clean, _clean_l, region="mumbai", limit=100, offset=50),
    "page_after": page_after,
    "key_history": _on(serving.key_history, _history_l, key="H7"),
    "aircraft": _on(serving.aircraft, _aircraft_dim),
    "airlines": _on(serving.airlines, _airline_dim),
    "metrics_window": _on(serving.metrics_window, _minutes, region="delhi", hours=HOURS, as_of=AS_OF),
    "kpi_list": _on(serving.kpi_list, _kpis_l),
    "kpi_value": _on(serving.kpi_value, _kpis_l, name="avg_altitude_ft", digits=0),
    "alerts": _on(serving.alerts, _current_l),
    "cdc_like": _on(serving.cdc_like, _cdc_l, text="ALT"),
    "regions": _on(serving.regions, _region_summary),
    "region_shares": _on(serving.region_shares, _region_summary),
    "operators": _on(serving.operators, _top_operators, limit=10),
    "trend_window": _on(serving.trend_window, _trend, hours=HOURS, as_of=AS_OF),
    "geojson": _on(serving.geojson, _current_l),
    "feature_count": _on(serving.feature_count, _current_l),
    "trend_counts": _on(serving.trend_counts, _trend),
    "trend_averages": _on(serving.trend_averages, _trend),
    "live_table": _on(serving.live_table, _current_l),
    "measures": _on(serving.measures, _current_l),
    "type_distribution": _on(serving.type_distribution, _current_l),
    "top_callsigns": _on(serving.top_callsigns, _current_l),
    "total_hourly_flights": _on(serving.total_hourly_flights, _trend),
    "growth_day_over_day": _on(serving.growth_day_over_day, _trend),
    "squawk_distribution": _on(serving.squawk_distribution, _current_l),
    "emergencies_by_hour": _on(serving.emergencies_by_hour, _trend),
    "event_counts": _on(serving.event_counts, _cdc_l),
    "typed_trend": _on(serving.typed_trend, _trend),
    # quality
    "row_count": _on(quality.row_count, _raw),
    "region_profile": _on(quality.region_profile, _raw),
    "null_profile": _on(quality.null_profile, _raw),
    "newest_rows": _on(quality.newest_rows, _raw),
    "time_range": _on(quality.time_range, _clean),
    "deletion_counts": _on(quality.deletion_counts, _clean),
    "reason_counts": _on(quality.reason_counts, _clean),
    "state_by_region": _on(quality.state_by_region, _state),
    "versions_by_state": _on(quality.versions_by_state, _history),
    "newest_active": _on(quality.newest_active, _state),
    "latest_scalars": _on(quality.latest_scalars, _metrics),
    "busiest_routes": _on(quality.busiest_routes, _routes),
    "busiest_cells": _on(quality.busiest_cells, _cells),
    "snapshot_history": _on(quality.snapshot_history, _metrics),
    "missing_required": _on(quality.missing_required, _clean, columns=schemas.REQUIRED["clean"]),
}
