"""One-row-per-key state: upsert, soft delete, restore, change feed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import schemas
from contrail.functions.time import instant
from contrail.sources.parted import PartedTable


def merge_current(
    state: DataFrame,
    latest: DataFrame,
    key: str = "hex",
    as_of: datetime | None = None,
    attributes: Sequence[str] = (*schemas.ATTRIBUTES_N, "last_seen_at"),
) -> DataFrame:
    """Upsert: a match takes the new attributes and loses its soft delete.

    Both sides have one row per key. An empty state is the first run. Columns of
    the state beyond these are carried along.
    """
    new, old = latest.alias("new"), state.alias("old")
    arrived = F.col(f"new.{key}").isNotNull()
    changed = {
        key: F.coalesce(f"new.{key}", f"old.{key}"),
        "is_deleted": F.when(arrived, F.lit(False)).otherwise(F.col("old.is_deleted")),
        "deleted_at": F.when(~arrived, F.col("old.deleted_at")),
        "deleted_reason": F.when(~arrived, F.col("old.deleted_reason")),
        "_updated_at": F.when(arrived, instant(as_of)).otherwise(F.col("old._updated_at")),
    }
    for name in attributes:
        changed[name] = F.when(arrived, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return joined.select(
        *[changed.get(name, F.col(f"old.{name}")).alias(name) for name in state.columns]
    )


def merge_buckets(
    table: PartedTable, latest: DataFrame, batch: int, as_of: datetime | None = None
) -> list[str]:
    """Upsert into state kept in hash buckets; gives the buckets it rewrote.

    Only buckets that hold a key of ``latest`` are read and written. Upserting
    the same rows again changes nothing, so a batch may be run again. Rows
    without a key are left out.
    """
    arrived = latest.filter(F.col("hex").isNotNull())
    return table.change(arrived, lambda known, rows: merge_current(known, rows, as_of=as_of), batch)


def set_deleted(
    state: DataFrame, keys: DataFrame, reason: str, as_of: datetime | None = None, key: str = "hex"
) -> DataFrame:
    """Soft-delete the state rows of the given keys."""
    return set_flagged_deleted(_flag_keys(state, keys, key), "_hit", reason, as_of)


def restore(
    state: DataFrame, keys: DataFrame, as_of: datetime | None = None, key: str = "hex"
) -> DataFrame:
    """Clear the soft delete of the given keys; closed history stays closed."""
    return restore_flagged(_flag_keys(state, keys, key), "_hit", as_of)


def set_flagged_deleted(
    state: DataFrame, flag: str, reason: str, as_of: datetime | None = None
) -> DataFrame:
    """Soft-delete the rows whose flag column is TRUE, and drop the flag."""
    changes = {
        "is_deleted": F.lit(True),
        "deleted_at": instant(as_of),
        "deleted_reason": F.lit(reason),
        "_updated_at": instant(as_of),
    }
    return _change_where(state, flag, changes)


def restore_flagged(state: DataFrame, flag: str, as_of: datetime | None = None) -> DataFrame:
    """Clear the soft delete of the rows whose flag column is TRUE, and drop the flag."""
    changes = {
        "is_deleted": F.lit(False),
        "deleted_at": F.lit(None).cast("timestamp"),
        "deleted_reason": F.lit(None).cast("string"),
        "_updated_at": instant(as_of),
    }
    return _change_where(state, flag, changes)


def _flag_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    marked = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    return df.join(marked, key, "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))


def _change_where(df: DataFrame, flag: str, changes: dict[str, Column]) -> DataFrame:
    hit = F.col(flag)
    return df.withColumns(
        {name: F.when(hit, new).otherwise(F.col(name)) for name, new in changes.items()}
    ).drop(flag)


def soft_delete(
    state: DataFrame,
    history: DataFrame,
    keys: DataFrame,
    reason: str = "MANUAL",
    as_of: datetime | None = None,
    key: str = "hex",
) -> tuple[DataFrame, DataFrame]:
    """(state, history) with the keys deleted and their open versions closed."""
    changes = {
        "effective_to": instant(as_of),
        "is_current": F.lit(False),
        "is_deleted": F.lit(True),
        "deleted_at": instant(as_of),
        "deleted_reason": F.lit(reason),
    }
    flagged = _flag_keys(history, keys, key).withColumn("_hit", F.col("_hit") & F.col("is_current"))
    closed = _change_where(flagged, "_hit", changes)
    return set_deleted(state, keys, reason, as_of, key), closed


def soft_deleted(state: DataFrame) -> DataFrame:
    """The soft-deleted keys, newest first."""
    return (
        state.filter("is_deleted")
        .select("hex", "callsign", "last_seen_at", "deleted_at", "deleted_reason")
        .orderBy(F.desc("deleted_at"), "hex")
    )


def change_feed(before: DataFrame, after: DataFrame, key: str = "hex") -> DataFrame:
    """Row changes between two versions of a keyed table.

    ``_change_type`` is insert, delete, update_preimage or update_postimage; an
    update gives both images. Unchanged rows give nothing.
    """
    old = before.select(F.col(key).alias("_old_key"), F.struct(*before.columns).alias("_old"))
    new = after.select(F.col(key).alias("_new_key"), F.struct(*before.columns).alias("_new"))
    joined = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
    differs = ~F.col("_old").eqNullSafe(F.col("_new"))
    was, is_now = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()

    def image(kind, row):
        return F.struct(kind.alias("kind"), F.col(row).alias("row"))

    gone = F.when(is_now, "update_preimage").otherwise("delete")
    came = F.when(was, "update_postimage").otherwise("insert")
    images = F.array_compact(
        F.array(
            F.when(was & differs, image(gone, "_old")),
            F.when(is_now & differs, image(came, "_new")),
        )
    )
    return joined.select(F.explode(images).alias("c")).select(
        "c.row.*", F.col("c.kind").alias("_change_type")
    )


def bucket_digests(table: PartedTable) -> DataFrame:
    """(bucket, digest): sums over the hashes of a bucket's rows, in any order of the rows."""
    rows = table.read()
    row = F.struct(*rows.columns)
    digest = F.struct(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64(row)), F.sum(F.hash(row).cast("bigint"))
    )
    return rows.groupBy(table.part.alias("bucket")).agg(digest.alias("digest"))


def changed_buckets(before: PartedTable, after: PartedTable) -> list[str]:
    """Buckets whose digests differ; at most as many names as the tables have buckets."""
    old = bucket_digests(before).withColumnRenamed("digest", "old")
    new = bucket_digests(after).withColumnRenamed("digest", "new")
    both = old.join(new, "bucket", "full_outer").filter(~F.col("old").eqNullSafe(F.col("new")))
    return sorted(r.bucket for r in both.select("bucket").collect())


def change_feed_digest(before: PartedTable, after: PartedTable, key: str = "hex") -> DataFrame:
    """:func:`change_feed` of two versions kept in the same hash buckets.

    A pass over each version adds up hashes per bucket, without a shuffle of
    rows; only buckets whose sums differ are read again and joined.
    """
    unequal = changed_buckets(before, after)
    return change_feed(before.read(unequal), after.read(unequal), key)
