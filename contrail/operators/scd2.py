"""Versioned history (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import schemas
from contrail.functions.time import instant, iso_text

_PROFILES = {
    "N": (schemas.HISTORY_N, schemas.TRACKED_N),
    "L": (schemas.HISTORY_L, schemas.TRACKED_L),
}


def scd2_step(
    open_rows: DataFrame,
    current: DataFrame,
    profile: str = "N",
    as_of: datetime | None = None,
    tracked: Sequence[str] | None = None,
    null_safe: bool = True,
    key: str = "hex",
) -> DataFrame:
    """Open versions plus current state to open versions plus newly closed ones.

    One join decides for each key: keep, open, or close and open. Rows with
    ``is_current`` are the new open set; the rest were closed at ``as_of``.
    Closed history never takes part, so the cost follows the number of keys.
    ``null_safe=False`` ignores changes from or to NULL.
    """
    schema, default_tracked = _PROFILES[profile]
    tracked = list(tracked or default_tracked)
    old = open_rows.select(F.col(key).alias("_old_key"), F.struct(*schema.names).alias("old"))
    new = current.select(F.col(key).alias("_new_key"), F.struct(*current.columns).alias("new"))
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    def moved(name: str) -> Column:
        a, b = F.col(f"old.{name}"), F.col(f"new.{name}")
        return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))

    known, seen = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()
    changed = F.array_compact(F.array(*[F.when(moved(n), F.lit(n)) for n in tracked]))
    replaced = known & seen & (F.size("_changed") > 0)
    reason = F.when(known, F.concat(F.lit("CHANGED:"), F.array_join("_changed", ","))).otherwise(
        "INITIAL_LOAD"
    )

    closed = {"effective_to": instant(as_of), "is_current": F.lit(False)}
    opened = {
        "effective_from": instant(as_of),
        "effective_to": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
        "is_deleted": F.lit(False),
        "deleted_at": F.lit(None).cast("timestamp"),
        "deleted_reason": F.lit(None).cast("string"),
        "change_reason": reason,
        "flight_sk": F.xxhash64("_new_key", instant(as_of)),
        "history_id": F.concat_ws("_", "_new_key", iso_text(as_of)),
    }

    def version(side: str, changes: dict[str, Column]) -> Column:
        return F.struct(
            *[
                (changes[f.name] if f.name in changes else F.col(f"{side}.{f.name}"))
                .cast(f.dataType)
                .alias(f.name)
                for f in schema.fields
            ]
        )

    rows = F.array_compact(
        F.array(
            F.when(known & ~replaced, version("old", {})),
            F.when(replaced, version("old", closed)),
            F.when(seen & (~known | replaced), version("new", opened)),
        )
    )
    return (
        both.withColumn("_changed", changed).select(F.explode(rows).alias("v")).select("v.*")
    )


def open_versions(history: DataFrame) -> DataFrame:
    rows = history.filter("is_current")
    return rows.filter("NOT coalesce(is_deleted, false)") if "is_deleted" in rows.columns else rows


def scd2_apply(
    history: DataFrame,
    current: DataFrame,
    profile: str = "N",
    as_of: datetime | None = None,
    tracked: Sequence[str] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """The whole history after one step; profile N looks at live keys only."""
    if "is_deleted" in current.columns:
        current = current.filter("is_deleted = false")
    step = scd2_step(open_versions(history), current, profile, as_of, tracked, null_safe)
    # Exactly the rows that open_versions leaves out: closed, deleted, or without the flag.
    deleted = "coalesce(is_deleted, false)" if "is_deleted" in history.columns else "false"
    untouched = history.filter(f"NOT coalesce(is_current, false) OR {deleted}")
    return untouched.unionByName(step)


def current_from_history(history: DataFrame) -> DataFrame:
    """Profile L's current table: the open versions. ``last_seen`` is the version start."""
    return history.filter("is_current").select(
        "hex",
        *schemas.ATTRIBUTES_L,
        F.col("effective_from").alias("last_seen"),
        F.col("effective_from").alias("updated_at"),
        "observed_at",
    )
