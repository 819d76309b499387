"""Every change of a key, not only the newest: versions and events from a log.

A row is compared with the row of its key before it. Where the compared columns
differ an island of equal rows ends and a version begins; its end is the start of
the next. A key may hold much of the data, so windows run over (key, day) and not
over keys: the last row of each day is carried over to the first row of the key's
next day, and running numbers are offsets of days plus numbers within a day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail import schemas
from contrail.functions.time import instant
from contrail.operators import cdc

_DAY = "_chunk"


def with_neighbour(
    df: DataFrame, key: str, time: str, ties: Sequence[Column], values: Sequence[str], name: str, newest_first: bool = False
) -> DataFrame:
    """The rows with ``name``, a struct of ``values`` of the row before in the order; NULL for none.

    The order of a key's rows is by ``time``, then ``ties``; with ``newest_first``
    time runs backwards. Rows without a key or a time have no place in it and
    are left out.
    """
    along = F.desc if newest_first else F.asc
    rows = df.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn(_DAY, F.date_trunc("day", time))
    inside = Window.partitionBy(key, _DAY).orderBy(along(time), *ties)
    held = rows.withColumns({
        "_near": F.lag(F.struct(*values)).over(inside),
        "_ends": F.lead(F.lit(False), 1, True).over(inside),
    })
    # One row per key and day: the last one in order, for the day that follows in order.
    days = Window.partitionBy(key).orderBy(along(_DAY))
    carried = held.filter("_ends").select(key, _DAY, F.struct(*values).alias("_last"))
    carried = carried.select(key, _DAY, F.lag("_last").over(days).alias("_carried"))
    both = held.join(carried, [key, _DAY], "left")
    return both.withColumn(name, F.coalesce("_near", "_carried")).drop(_DAY, "_near", "_ends", "_carried")


def with_number(df: DataFrame, key: str, time: str, name: str) -> DataFrame:
    """The rows numbered from 1 by time within their key; times of a key differ."""
    rows = df.withColumn(_DAY, F.date_trunc("day", time))
    days = Window.partitionBy(key).orderBy(_DAY).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(key, _DAY).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(key, _DAY, F.coalesce(F.sum("_n").over(days), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, _DAY).orderBy(time)
    numbered = rows.join(before, [key, _DAY]).withColumn(name, F.col("_before") + F.row_number().over(inside))
    return numbered.drop(_DAY, "_before")


def changes_of(
    clean: DataFrame, tracked: Sequence[str], time: str, row_id: str | None = None, opened: DataFrame | None = None
) -> DataFrame:
    """Rows (hex, time, tracked, ``changed``) at which the tracked columns of a key take other values.

    ``changed`` lists the columns, and is NULL for the first row of a key. Rows of
    one time count as one, that of the smallest ``row_id``. ``opened`` are versions
    known before, one per key, with their values and ``effective_from``; a key's
    rows are compared with them first, and rows not newer than them are left out.
    """
    rows = clean.select("hex", F.col(time).alias("_at"), *tracked, *([row_id] if row_id else []))
    best = F.min_by(F.struct(*tracked), row_id) if row_id else F.min(F.struct(*tracked))
    rows = rows.groupBy("hex", "_at").agg(best.alias("_v")).select("hex", "_at", "_v.*", F.lit(False).alias("_open"))
    if opened is not None:
        starts = opened.select("hex", F.col("effective_from").alias("_from"))
        newer = rows.join(starts, "hex", "left").filter("_from IS NULL OR _at > _from").drop("_from")
        known = opened.select("hex", F.col("effective_from").alias("_at"), *tracked, F.lit(True).alias("_open"))
        rows = newer.unionByName(known)
    paired = with_neighbour(rows, "hex", "_at", [], tracked, "_prev")
    moved = F.array_compact(F.array(*[F.when(~F.col(n).eqNullSafe(F.col(f"_prev.{n}")), F.lit(n)) for n in tracked]))
    changed = F.when(F.col("_prev").isNotNull(), moved)
    return paired.withColumn("changed", changed).filter("changed IS NULL OR size(changed) > 0").drop("_prev")


def scd2_from_log(
    clean: DataFrame,
    tracked: Sequence[str] = schemas.TRACKED_N,
    time: str = "fetched_at",
    row_id: str | None = "ingestion_id",
    opened: DataFrame | None = None,
) -> DataFrame:
    """All versions of every key: (hex, tracked, effective_from, effective_to, is_current, version, change_reason).

    Unlike :func:`contrail.operators.scd2.scd2_step`, which compares the newest
    row of a batch, every change in the log opens a version at the time it was
    observed. Soft-deleted rows do not count. With ``opened`` the open versions
    of an earlier run go on: they come out closed or still open under their own
    start, and ``version`` counts from them.
    """
    rows = clean.filter("is_deleted = false") if "is_deleted" in clean.columns else clean
    starts = changes_of(rows, tracked, time, row_id, opened)
    ended = with_neighbour(starts, "hex", "_at", [], ["_at"], "_next", newest_first=True)
    numbered = with_number(ended, "hex", "_at", "version")
    reason = F.when(F.col("changed").isNull(), "INITIAL_LOAD").otherwise(
        F.concat(F.lit("CHANGED:"), F.array_join("changed", ","))
    )
    return numbered.select(
        "hex", *tracked, F.col("_at").alias("effective_from"), F.col("_next._at").alias("effective_to"),
        F.col("_next").isNull().alias("is_current"), "version", reason.alias("change_reason"),
    )


def cdc_from_log(
    clean: DataFrame,
    thresholds: cdc.Thresholds = cdc.THRESHOLDS_N,
    since: datetime | Column | None = None,
    as_of: datetime | None = None,
    wrap_heading: bool = False,
) -> DataFrame:
    """Change events of every live observation against the one before, in the form of ``cdc_long``.

    ``since`` keeps events newer than it; older rows serve as predecessors. For
    a batch, add what the state remembers by ``cdc.with_previous_state``.
    """
    rows = clean.filter("is_deleted = false").select("hex", *cdc.MEASURES, "fetched_at", "ingestion_id")
    paired = with_neighbour(rows, "hex", "fetched_at", [F.desc("ingestion_id")], cdc.MEASURES, "_prev")
    pairs = paired.withColumns(
        {"has_prev": F.col("_prev").isNotNull(), **{f"prev_{n}": F.col(f"_prev.{n}") for n in cdc.MEASURES}}
    )
    if since is not None:
        mark = instant(since) if isinstance(since, datetime) else since
        pairs = pairs.filter(F.col("fetched_at") > mark)
    return cdc.pair_events(pairs, thresholds, as_of, wrap_heading)
