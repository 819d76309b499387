"""Keys that vanish and return, and the rate at which they do."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions import columns as C
from contrail.functions.time import instant, minus_minutes
from contrail.operators.keyed import lookup
from contrail.operators.state import restore_flagged, set_flagged_deleted

# Fixed values, in minutes.
GRACE_MINUTES = 5
SUPPRESS_MINUTES = 10


def latest_fetch(raw: DataFrame):
    """Newest poll time as a scalar subquery (NULL for no rows)."""
    return raw.agg(F.max("fetched_at").alias("latest")).scalar()


def keys_in_latest_fetch(raw: DataFrame) -> DataFrame:
    newest = raw.filter(F.col("fetched_at") == latest_fetch(raw))
    return newest.filter(F.col("hex").isNotNull()).select("hex").distinct()


def _with_polled(state: DataFrame, raw: DataFrame) -> DataFrame:
    """The state with ``_polled``: is the key in the latest poll?"""
    polled = keys_in_latest_fetch(raw).withColumn("_polled", F.lit(True))
    return state.join(polled, "hex", "left").withColumn(
        "_polled", F.coalesce("_polled", F.lit(False))
    )


def with_vanished(
    state: DataFrame, raw: DataFrame, grace_minutes: int = GRACE_MINUTES, flag: str = "_gone"
) -> DataFrame:
    """Flag live keys silent for longer than the grace period and not in the latest poll.

    ``grace_minutes=0`` flags every live key older than the latest poll.
    """
    silent = F.col("last_seen_at") < minus_minutes(latest_fetch(raw), grace_minutes)
    gone = ~F.col("is_deleted") & silent & ~F.col("_polled")
    return (
        _with_polled(state, raw).withColumn(flag, F.coalesce(gone, F.lit(False))).drop("_polled")
    )


def with_returned(state: DataFrame, raw: DataFrame, flag: str = "_back") -> DataFrame:
    """Flag vanished keys that are in the latest poll."""
    away = F.col("is_deleted") & (F.col("deleted_reason") == C.DISAPPEARED)
    back = F.coalesce(away & F.col("_polled"), F.lit(False))
    return _with_polled(state, raw).withColumn(flag, back).drop("_polled")


def vanished(state: DataFrame, raw: DataFrame, grace_minutes: int = GRACE_MINUTES) -> DataFrame:
    flagged = with_vanished(state, raw, grace_minutes)
    return flagged.filter("_gone").select("hex", "callsign", "last_seen_at")


def returned(state: DataFrame, raw: DataFrame) -> DataFrame:
    return with_returned(state, raw).filter("_back").select("hex", "callsign")


def vanish_events(
    gone: DataFrame,
    raw: DataFrame,
    cdc: DataFrame,
    suppress_minutes: int = SUPPRESS_MINUTES,
    as_of: datetime | None = None,
) -> DataFrame:
    """DISAPPEARED events, except for keys logged shortly before the latest poll."""
    logged = cdc.filter(
        (F.col("change_type") == C.DISAPPEARED)
        & (F.col("detected_at") >= minus_minutes(latest_fetch(raw), suppress_minutes))
    )
    return vanish_rows(gone.join(logged.select("hex").distinct(), "hex", "left_anti"), as_of)


def vanish_rows(gone: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """A DISAPPEARED event for each of the keys."""
    return gone.select(
        "hex",
        "callsign",
        F.lit(C.DISAPPEARED).alias("change_type"),
        F.col("last_seen_at").cast("string").alias("old_value"),
        F.lit(None).cast("string").alias("new_value"),
        F.col("last_seen_at").alias("event_at"),
        instant(as_of).alias("detected_at"),
    )


def logged_recently(raw: DataFrame, suppress_minutes: int = SUPPRESS_MINUTES) -> Column:
    """Was the key's last DISAPPEARED event (``logged_at`` of the state) logged shortly before the latest poll?"""
    since = minus_minutes(latest_fetch(raw), suppress_minutes)
    return F.coalesce(F.col("logged_at") >= since, F.lit(False))


def cascade_deleted(
    clean: DataFrame, gone: DataFrame, reason: str = C.DISAPPEARED, as_of: datetime | None = None
) -> DataFrame:
    """Soft-delete the live clean rows of the given keys."""
    marked = gone.select("hex").distinct().withColumn("_hit", F.lit(True))
    hit = F.coalesce("_hit", F.lit(False)) & ~F.col("is_deleted")
    changes = {
        "is_deleted": F.lit(True),
        "deleted_at": instant(as_of),
        "deleted_reason": F.lit(reason),
    }
    return lookup(clean, marked, ["hex"]).select(
        *[
            (F.when(hit, changes[n]).otherwise(F.col(n)) if n in changes else F.col(n)).alias(n)
            for n in clean.columns
        ]
    )


def mark_disappeared(
    state: DataFrame,
    raw: DataFrame,
    clean: DataFrame,
    cdc: DataFrame,
    grace_minutes: int = GRACE_MINUTES,
    suppress_minutes: int = SUPPRESS_MINUTES,
    cascade_clean: bool = True,
    as_of: datetime | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(state, clean, events) after flagging vanished keys."""
    gone = vanished(state, raw, grace_minutes)
    events = vanish_events(gone, raw, cdc, suppress_minutes, as_of)
    flagged = cascade_deleted(clean, gone, as_of=as_of) if cascade_clean else clean
    new_state = set_flagged_deleted(
        with_vanished(state, raw, grace_minutes), "_gone", C.DISAPPEARED, as_of
    )
    return new_state, flagged, events


def reactivate(
    state: DataFrame, raw: DataFrame, as_of: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """(state, events): returnees become live and are logged once each."""
    back = returned(state, raw)
    events = back.select(
        "hex",
        "callsign",
        F.lit("NEW").alias("change_type"),
        F.lit(C.DISAPPEARED).alias("old_value"),
        F.lit("REACTIVATED").alias("new_value"),
        latest_fetch(raw).alias("event_at"),
        instant(as_of).alias("detected_at"),
    )
    return restore_flagged(with_returned(state, raw), "_back", as_of), events


def disappeared_since(state: DataFrame, minutes: int = 60, as_of: datetime | None = None) -> DataFrame:
    """Number of keys that vanished in the window."""
    recent = F.col("deleted_at") >= minus_minutes(instant(as_of), minutes)
    return state.filter(
        F.col("is_deleted") & (F.col("deleted_reason") == C.DISAPPEARED) & recent
    ).agg(F.count_distinct("hex").alias("disappeared_aircraft"))


def disappearance_rate(
    state: DataFrame, minutes: int = 60, as_of: datetime | None = None
) -> DataFrame:
    """Vanished in the window against live plus vanished; 0 when nothing was seen.

    The state has one row per key, so rows are keys and no distinct is needed.
    """
    deleted, reason = F.col("is_deleted"), F.col("deleted_reason")
    recent = F.col("deleted_at") >= minus_minutes(instant(as_of), minutes)

    vanished_recently = deleted & (reason == C.DISAPPEARED) & recent
    counts = state.agg(
        F.count_if(~deleted).alias("active_now"),
        F.count_if(vanished_recently).alias("disappeared_in_window"),
        F.count_if(deleted & (reason == C.INVALID_POSITION)).alias("invalid_coords_total"),
        F.count_if(deleted & (reason == C.DUPLICATE)).alias("duplicates_total"),
    )
    gone = F.col("disappeared_in_window")
    rate = F.coalesce(C.percent(gone, F.col("active_now") + gone), F.lit(0.0))
    return counts.withColumn("disappearance_rate", rate)


def disappearance_by_minute(
    cdc: DataFrame,
    state: DataFrame,
    minutes: int = 60,
    as_of: datetime | None = None,
    buckets: int = 20,
) -> DataFrame:
    """Vanished keys per minute against the live ones, newest minutes first."""
    active = state.filter("is_deleted = false").agg(F.count_distinct("hex").alias("n")).scalar()
    recent = F.col("detected_at") >= minus_minutes(instant(as_of), minutes)
    per_minute = (
        cdc.filter((F.col("change_type") == C.DISAPPEARED) & recent)
        .groupBy(F.date_trunc("minute", "detected_at").alias("minute_bucket"))
        .agg(F.count_distinct("hex").alias("disappeared_count"))
    )
    return (
        per_minute.withColumn("total_active", active)
        .withColumn("rate_pct", C.percent(F.col("disappeared_count"), F.col("total_active")))
        .orderBy(F.desc("minute_bucket"))
        .limit(buckets)
    )
