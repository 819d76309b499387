"""Structured Streaming forms of the batch operators.

Progress lives in the source checkpoint, lateness in the watermark. Exact
distinct counts need unbounded state, so streams report approximate ones.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from contrail import schemas
from contrail.functions.time import minus_minutes
from contrail.operators.clean import clean_observations
from contrail.plans import bitmaps
from contrail.plans.medallion import run_silver, run_silver_local
from contrail.sources.snapshots import flatten_enriched, flatten_snapshots, stream_documents
from contrail.sources.tables import Lake

LATENESS = "10 minutes"


def stream_snapshots(
    spark: SparkSession,
    path: str,
    profile: str = "N",
    multi_line: bool = True,
    max_files: int | None = None,
) -> DataFrame:
    """Raw observations from a growing folder of snapshot documents."""
    docs = stream_documents(spark, path, multi_line, max_files)
    return flatten_snapshots(docs) if profile == "N" else flatten_enriched(docs)


def drop_repeats(
    raw: DataFrame, lateness: str = LATENESS, keys: tuple[str, ...] = ("hex", "fetched_at")
) -> DataFrame:
    """First row per key within the watermark; batch cleaning flags instead of dropping."""
    return raw.withWatermark("fetched_at", lateness).dropDuplicatesWithinWatermark(list(keys))


def best_rows(
    raw: DataFrame, lateness: str = LATENESS, keys: tuple[str, ...] = ("hex", "fetched_at")
) -> DataFrame:
    """The best row per key, not the first to arrive: smallest ``seen``, NULL last, then smallest id.

    State holds one row per key until the watermark passes it. Write it with
    :func:`write_newest`: a better row that comes later replaces the earlier one.
    """
    standing = F.struct(F.col("seen").isNull(), "seen", "ingestion_id")
    others = [c for c in raw.columns if c not in keys]
    best = F.min_by(F.struct(*others), standing).alias("best")
    kept = raw.withWatermark("fetched_at", lateness).groupBy(*keys).agg(best)
    return kept.select(*[F.col(c) if c in keys else F.col(f"best.{c}") for c in raw.columns])


def presence_intervals(clean: DataFrame, gap: str = "30 minutes", lateness: str = LATENESS) -> DataFrame:
    """Stretches in which a key was seen again within ``gap``: (hex, seen_from, seen_to, observations).

    A batch gives all; a stream gives a stretch in append mode once the watermark
    has passed its end.
    """
    rows = clean.filter("hex IS NOT NULL AND ingested_at IS NOT NULL")
    if clean.isStreaming:
        rows = rows.withWatermark("ingested_at", lateness)
    return (
        rows.groupBy("hex", F.session_window("ingested_at", gap).alias("w"))
        .agg(F.min("ingested_at").alias("seen_from"), F.max("ingested_at").alias("seen_to"), F.count(F.lit(1)).alias("observations"))
        .drop("w")
    )


def clean_stream(raw: DataFrame) -> DataFrame:
    """Profile L has no duplicate rule, so it cleans row by row on a stream too."""
    return clean_observations(raw, "L")


def _bucketed(clean: DataFrame, size: str, lateness: str):
    marked = clean.withWatermark("ingested_at", lateness)
    return marked.groupBy(F.window("ingested_at", size).alias("w"), "region")


def minute_metrics(clean: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Closed minutes per region, in append mode."""
    return (
        _bucketed(clean, "1 minute", lateness)
        .agg(
            F.count(F.lit(1)).alias("total_flights"),
            F.count_if(F.col("on_ground")).alias("on_ground"),
            F.count_if(~F.col("on_ground")).alias("airborne"),
            F.avg("altitude_ft").alias("avg_altitude_ft"),
            F.max("altitude_ft").alias("max_altitude_ft"),
            F.avg("gs_knots").alias("avg_speed_knots"),
            F.max("gs_knots").alias("max_speed_knots"),
            F.count_if(F.col("is_emergency")).alias("emergency_count"),
            F.approx_count_distinct("hex").alias("unique_aircraft_approx"),
            F.approx_count_distinct(F.substring("flight", 1, 3)).alias("unique_airlines_approx"),
        )
        .select(F.col("w.start").alias("metric_time"), "*")
        .drop("w")
    )


def hourly_trend(clean: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Closed hours per region, in append mode."""
    return (
        _bucketed(clean, "1 hour", lateness)
        .agg(
            F.approx_count_distinct("hex").alias("flight_count_approx"),
            F.avg("altitude_ft").alias("avg_altitude_ft"),
            F.avg("gs_knots").alias("avg_speed_knots"),
            F.count_if(F.col("is_emergency")).alias("emergency_count"),
        )
        .select(F.col("w.start").alias("hour_bucket"), "*")
        .drop("w")
    )


def write_parquet(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append to a folder: all that is there now, or a trigger every interval."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def write_newest(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write the touched rows of each batch, open windows too; an epoch run again replaces its folder."""

    def step(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        df.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**trigger)
        .start()
    )


def read_newest(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """What ``write_newest`` wrote: the row of the last epoch per key."""
    rows = spark.read.schema(StructType([*schema, StructField("epoch", LongType())])).parquet(path)
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*schema.names), "epoch").alias("r"))
    return newest.select("r.*")


def write_with_late(
    raw: DataFrame, lake: Lake, checkpoint: str, lateness_minutes: int = 10, time: str = "fetched_at", every: str | None = None
) -> StreamingQuery:
    """Append every micro-batch to the log ``on_time`` or ``late``; no row is dropped.

    A row is late if it is older than the newest time of the epochs before, less
    the lateness; rows without a time are on time. The counts of an epoch are
    observed while its rows are written and stand in its commit, and the newest
    time goes on as state, so an epoch delivered again is split the same way.
    """
    progress = schemas.struct("newest TIMESTAMP")

    def step(batch: DataFrame, epoch: int) -> None:
        before = lake.last_commit(before=epoch)
        known = lake.read_state("newest", progress, before)
        mark = known.agg(F.max("newest").alias("newest")).scalar()
        late = F.coalesce(F.col(time) < minus_minutes(mark, lateness_minutes), F.lit(False))
        seen = Observation(f"epoch {epoch}")
        counts = F.count_if("_late").alias("late_rows"), F.count_if(~F.col("_late")).alias("on_time_rows")
        split = batch.withColumn("_late", late).persist()
        try:
            watched = split.observe(seen, *counts, F.max(time).alias("newest"))
            lake.write_log("on_time", watched.filter("NOT _late").drop("_late"), epoch)
            lake.write_log("late", split.filter("_late").drop("_late"), epoch)
        finally:
            split.unpersist()
        found = seen.get
        newest = split.sparkSession.createDataFrame([(found["newest"],)], progress)
        lake.write_state("newest", known.unionByName(newest).agg(F.max("newest").alias("newest")), epoch)
        metrics = newest.select(*[F.lit(found[n]).alias(n) for n in ("on_time_rows", "late_rows")])
        lake.commit(epoch, "SPLIT", metrics, datetime.now(timezone.utc), f"{checkpoint}#{epoch}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return raw.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def write_buckets(
    clean: DataFrame, store: bitmaps.Store, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Fold every micro-batch of clean rows into exact minute or hour marts.

    No watermark is needed: open buckets and late rows are added like any other,
    and an epoch delivered again reaches only the days that lack it.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        bitmaps.fold(store, batch, epoch)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        clean.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def write_silver(
    raw: DataFrame,
    lake: Lake,
    checkpoint: str,
    profile: str = "N",
    every: str | None = None,
    clock: Callable[[], datetime] | None = None,
    **options,
) -> StreamingQuery:
    """Run the silver layer on every micro-batch.

    The commit names the epoch it came from. An epoch delivered again after its
    commit is skipped; one that failed before it is run again into the same
    folders. ``clock`` supplies ``as_of``; by default it is the wall clock.
    """
    run = run_silver if profile == "N" else run_silver_local
    schema = schemas.RAW_N if profile == "N" else schemas.RAW_L

    def step(batch: DataFrame, epoch: int) -> None:
        source = f"{checkpoint}#{epoch}"
        if lake.has_taken(source):
            return
        now = clock() if clock else datetime.now(timezone.utc)
        run(lake, batch.select(*schema.names), lake.last_commit() + 1, now, source=source, **options)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        raw.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
