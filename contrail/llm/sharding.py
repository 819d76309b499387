"""Sharding by a two-pass external shuffle, without Python tasks.

Pass one scatters the whole records by seeded hashes into buckets that fit in
memory; Spark's exchange writes them, one partition a bucket. Pass two reads one
bucket at a time, permutes it (Spark's ``shuffle`` of an array is a Fisher-Yates
shuffle), numbers its slots from where the bucket starts in its shard, and
writes the shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.scratch import store

BUCKET_BYTES = 16 << 20  # of records, as they lie in memory
PARTITIONS = 50_000  # most tasks of the scatter; a task takes its buckets one after the other


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """Struct (score, shard): the shard with the highest hash of (key, shard).

    A further shard only ever takes rows to itself.
    """
    scores = [F.struct(F.xxhash64(F.lit(seed), key, F.lit(i)).alias("score"), F.lit(i).alias("shard")) for i in range(shards)]
    return F.array_max(F.array(*scores))


def shard_rows(
    docs: DataFrame, shards: int, key: str = "doc_id", size: str = "size", seed: int = 8,
    bucket_bytes: int = BUCKET_BYTES, number: Sequence[str] = (), partitions: int = PARTITIONS,
) -> DataFrame:
    """All columns of ``docs`` plus ``shard``, ``slot`` and ``grown_shard``.

    ``key`` and the number of shards decide the shard (null is a key like any
    other); ``grown_shard`` is the shard with one more. Slots count from 0
    without gaps in random order. ``size`` says how large a record is. Columns
    named like the results are replaced. Equal rows are kept. An empty table
    gives no rows. ``number`` names the columns that tell rows apart, such as
    file and row index; they are not returned. Without it the table is stored
    first and numbered by that. A row's number decides its bucket, so records
    of one key, equal ones too, do not have to share one.
    """
    made = ["shard", "slot", "grown_shard"]
    kept = [c for c in docs.columns if c not in (*made, *number)]
    if not number:
        number = ["_file", "_row"]
        docs = store(docs.select(*kept), "records").select(
            *kept, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
        )
    best, grown = shard_of(F.col(key), shards, seed), shard_of(F.col(key), shards + 1, seed)
    held = docs.withColumn("_shard", best["shard"])
    bytes_of = dict(held.groupBy("_shard").agg(F.sum(F.coalesce(F.col(size), F.lit(0)) + 64).cast("long")).collect())
    buckets = [max(1, -(-bytes_of.get(i, 0) // bucket_bytes)) for i in range(shards)]
    # Cells count the buckets of all shards in order.
    firsts = [sum(buckets[:i]) for i in range(shards)]
    of_shard = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("_shard") + 1)
    spread = F.pmod(F.xxhash64(F.lit(seed + 1), *number), of_shard(buckets))
    held = held.withColumn("_cell", (of_shard(firsts) + spread).cast("int"))

    before = Window.partitionBy("_shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        held.groupBy("_shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    # A bucket's start travels to its task with the records, so neither side is sent to all executors.
    record = F.struct(F.xxhash64(F.lit(seed + 2), *number).alias("_h"), *number, *kept, grown["shard"].alias("_grown"))
    records = held.select("_shard", "_cell", F.lit(None).cast("long").alias("_start"), record.alias("_record"))
    tasks = min(sum(buckets), partitions)
    scattered = records.unionByName(starts, allowMissingColumns=True).withColumn("_task", F.pmod("_cell", F.lit(tasks))).repartitionById(tasks, F.col("_task"))
    # Nothing is exchanged after the permutation, so a task that runs again replaces it whole.
    held = scattered.groupBy("_task", "_cell").agg(
        F.first("_shard").alias("_shard"), F.max("_start").alias("_start"), F.sort_array(F.collect_list("_record")).alias("_rows")
    )
    out = held.select("_shard", "_start", F.posexplode(F.shuffle("_rows", F.lit(seed))).alias("_pos", "_r"))
    return out.select(
        *[F.col("_r")[c].alias(c) for c in kept],
        F.col("_shard").alias("shard"),
        (F.col("_start") + F.col("_pos")).cast("long").alias("slot"),
        F.col("_r")["_grown"].alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, path: str) -> DataFrame:
    """One folder a shard, its files in slot order; the written rows."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return sharded.sparkSession.read.schema(sharded.schema).parquet(path).select(*sharded.columns)
