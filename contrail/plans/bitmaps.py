"""Minute and hour marts with exact distinct counts that a batch only adds to.

Keys get numbers, and a bucket holds the numbers it has seen as bitmaps. Bitmaps
merge, as counts, sums and peaks do, so a batch, late or not, costs its own rows
and the days it touches; the clean log is never opened. Keys are numbered within
hash buckets, the numbers of the buckets interleaved, so numbering needs no
single order and stays dense.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail import schemas
from contrail.sources import parted

SPREAD = 32  # hash buckets of the numbering
WORD = 64  # numbers of a bitmap's block: one long, so a bucket with few keys costs a row for each and no more
NUMBERS = schemas.struct("value STRING, num BIGINT")
_SUMS = "total_flights on_ground airborne altitude_n altitude_sum speed_n speed_sum emergency_count".split()
_PEAKS = ["max_altitude_ft", "max_speed_knots"]
TOTALS = schemas.struct(
    "bucket TIMESTAMP, region STRING, total_flights BIGINT, on_ground BIGINT, airborne BIGINT, "
    "altitude_n BIGINT, altitude_sum DOUBLE, speed_n BIGINT, speed_sum DOUBLE, emergency_count BIGINT, "
    "max_altitude_ft DOUBLE, max_speed_knots DOUBLE"
)
BITS = schemas.struct("bucket TIMESTAMP, region STRING, kind STRING, block BIGINT, bits BIGINT")


def _kinds() -> dict[str, Column]:
    """What is counted: keys, and callsign prefixes."""
    return {"hex": F.col("hex"), "airline": F.substring("flight", 1, 3)}


@dataclass(frozen=True)
class Store:
    """The tables of one unit (``minute`` or ``hour``) below ``root``."""

    spark: SparkSession
    root: str
    unit: str

    @property
    def totals(self) -> parted.PartedTable:
        return parted.by_day(self.spark, f"{self.root}/{self.unit}_totals", TOTALS, "bucket")

    @property
    def bits(self) -> parted.PartedTable:
        return parted.by_day(self.spark, f"{self.root}/{self.unit}_bits", BITS, "bucket")

    def numbers(self, kind: str) -> parted.PartedTable:
        return parted.bucketed(self.spark, f"{self.root}/{kind}_numbers", NUMBERS, SPREAD, "value")


def number_values(known: DataFrame, values: DataFrame) -> DataFrame:
    """``known`` and the new ones of the distinct ``values``, with the next numbers of their hash bucket."""
    bucket = parted.hash_bucket(SPREAD, "value").cast("int")
    fresh = values.join(known, "value", "left_anti").withColumn("_b", bucket)
    used = known.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_used"))
    rank = F.coalesce("_used", F.lit(0)) + F.row_number().over(Window.partitionBy("_b").orderBy("value"))
    # From 1: rank r of bucket b is (r - 1) * SPREAD + b + 1.
    numbered = fresh.join(used, "_b", "left").select("value", ((rank - 1) * SPREAD + F.col("_b") + 1).cast("bigint").alias("num"))
    return known.unionByName(numbered)


def add_numbers(store: Store, batch: DataFrame, batch_id: int) -> None:
    """Number the keys and prefixes that a batch brings; known ones keep theirs."""
    for kind, value in _kinds().items():
        values = batch.select(value.alias("value")).filter("value IS NOT NULL").distinct()
        store.numbers(kind).change(values, number_values, batch_id)


def totals_of(batch: DataFrame, unit: str) -> DataFrame:
    return batch.groupBy(F.date_trunc(unit, "ingested_at").alias("bucket"), "region").agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count_if(F.col("on_ground")).alias("on_ground"),
        F.count_if(~F.col("on_ground")).alias("airborne"),
        F.count("altitude_ft").alias("altitude_n"), F.sum("altitude_ft").alias("altitude_sum"),
        F.count("gs_knots").alias("speed_n"), F.sum("gs_knots").alias("speed_sum"),
        F.count_if(F.col("is_emergency")).alias("emergency_count"),
        F.max("altitude_ft").alias("max_altitude_ft"), F.max("gs_knots").alias("max_speed_knots"),
    ).select(*TOTALS.names)


def merge_totals(known: DataFrame, rows: DataFrame) -> DataFrame:
    both = known.unionByName(rows).groupBy("bucket", "region")
    return both.agg(*[F.sum(n).alias(n) for n in _SUMS], *[F.max(n).alias(n) for n in _PEAKS]).select(*TOTALS.names)


def bits_of(batch: DataFrame, unit: str, numbers: dict[str, DataFrame]) -> DataFrame:
    """Bitmaps of the numbers seen per bucket, region and kind, in blocks of ``WORD`` numbers."""
    place = F.pmod("num", F.lit(WORD))
    block = ((F.col("num") - place) / WORD).cast("bigint").alias("block")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))
    out = None
    for kind, value in _kinds().items():
        seen = batch.select(F.date_trunc(unit, "ingested_at").alias("bucket"), "region", value.alias("value")).filter("value IS NOT NULL")
        # Distinct first: a map task sends a value once per bucket, however often it was seen.
        found = seen.distinct().join(numbers[kind], "value")
        made = found.groupBy("bucket", "region", block).agg(F.bit_or(bit).alias("bits")).withColumn("kind", F.lit(kind)).select(*BITS.names)
        out = made if out is None else out.unionByName(made)
    return out


def merge_bits(known: DataFrame, rows: DataFrame) -> DataFrame:
    both = known.unionByName(rows).groupBy("bucket", "region", "kind", "block")
    return both.agg(F.bit_or("bits").alias("bits")).select(*BITS.names)


_NEEDED = "hex flight region ingested_at on_ground altitude_ft gs_knots is_emergency".split()


def fold(store: Store, batch: DataFrame, batch_id: int) -> None:
    """Take a batch of clean rows (profile L) into the store.

    Batches are numbered upwards. A batch run again after a failure is added
    only to the days that lack it.
    """
    rows = batch.select(*_NEEDED).persist()  # read several times; lost partitions are read again
    try:
        add_numbers(store, rows, batch_id)
        numbers = {kind: store.numbers(kind).read() for kind in _kinds()}
        days = sorted(r[0] for r in rows.select(parted.day_of("ingested_at")).distinct().collect())
        store.totals.change(totals_of(rows, store.unit), merge_totals, batch_id, once=True, parts=days)
        store.bits.change(bits_of(rows, store.unit, numbers), merge_bits, batch_id, once=True, parts=days)
    finally:
        rows.unpersist()


def _measured(store: Store) -> DataFrame:
    """Totals and distinct counts in one pass: bitmaps add their size to the bucket's row."""
    totals = store.totals.read().withColumns({kind: F.lit(0).cast("bigint") for kind in _kinds()})
    size = F.bit_count("bits")
    sizes = {kind: F.when(F.col("kind") == kind, size).otherwise(F.lit(0)).cast("bigint") for kind in _kinds()}
    counts = store.bits.read().select("bucket", "region", *[c.alias(kind) for kind, c in sizes.items()])
    both = totals.unionByName(counts, allowMissingColumns=True).groupBy("bucket", "region")
    return both.agg(
        *[F.sum(n).alias(n) for n in (*_SUMS, *_kinds())], *[F.max(n).alias(n) for n in _PEAKS]
    ).withColumns({
        "avg_altitude_ft": F.try_divide("altitude_sum", "altitude_n"),
        "avg_speed_knots": F.try_divide("speed_sum", "speed_n"),
    })


def minute_metrics(store: Store) -> DataFrame:
    """What :func:`contrail.plans.marts.minute_metrics` makes from the log."""
    return _measured(store).select(
        F.col("bucket").alias("metric_time"), "region", "total_flights", "on_ground", "airborne", "avg_altitude_ft",
        "max_altitude_ft", "avg_speed_knots", "max_speed_knots", "emergency_count",
        F.col("hex").alias("unique_aircraft"), F.col("airline").alias("unique_airlines"),
    )


def hourly_trend(store: Store) -> DataFrame:
    """What :func:`contrail.plans.marts.hourly_trend` makes from the log."""
    return _measured(store).select(
        F.col("bucket").alias("hour_bucket"), "region", F.col("hex").alias("flight_count"),
        "avg_altitude_ft", "avg_speed_knots", "emergency_count",
    )
