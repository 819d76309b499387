"""Change events between observations of a key."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions import columns as C
from contrail.functions.time import instant, iso_text
from contrail.operators.keyed import latest_with_previous


@dataclass(frozen=True)
class Thresholds:
    """A change counts when it exceeds the limit."""

    position: float
    altitude: float
    speed: float
    heading: float


# Degrees, feet, knots, degrees.
THRESHOLDS_N = Thresholds(position=0.001, altitude=100, speed=10, heading=5)
THRESHOLDS_L = Thresholds(position=0.001, altitude=50, speed=5, heading=2)

MEASURES = ["callsign", "lat", "lon", "alt_baro", "gs", "track"]


def cdc_long(
    clean: DataFrame,
    thresholds: Thresholds = THRESHOLDS_N,
    since: datetime | Column | None = None,
    as_of: datetime | None = None,
    wrap_heading: bool = False,
) -> DataFrame:
    """One row per key and kind of change: NEW, POSITION, ALTITUDE, SPEED, HEADING.

    Compares the newest live observation of a key with the one before. A missing
    altitude, speed or heading counts as 0. ``event_at`` is the observation
    time; ``since`` keeps events newer than it.
    """
    pairs = latest_with_previous(
        clean.filter("is_deleted = false").select(
            "hex", *MEASURES, "fetched_at", "ingestion_id"
        ),
        ["hex"],
        [F.desc("fetched_at"), F.col("ingestion_id")],
        MEASURES,
    )
    if since is not None:
        mark = instant(since) if isinstance(since, datetime) else since
        pairs = pairs.filter(F.col("fetched_at") > mark)

    return pair_events(pairs, thresholds, as_of, wrap_heading)


def pair_events(
    pairs: DataFrame, thresholds: Thresholds, as_of: datetime | None = None, wrap_heading: bool = False
) -> DataFrame:
    """Events of observations paired with the one before (``prev_`` columns and ``has_prev``)."""
    seen = F.col("has_prev")

    def gap(name: str) -> Column:
        zero = F.lit(0)
        return F.abs(F.coalesce(name, zero) - F.coalesce(f"prev_{name}", zero))

    def event(kind: str, happened: Column, old: Column, new: Column) -> Column:
        row = F.struct(
            F.lit(kind).alias("change_type"),
            old.cast("string").alias("old_value"),
            new.cast("string").alias("new_value"),
        )
        return F.when(happened, row)

    def place(prefix: str) -> Column:
        return F.concat(F.col(f"{prefix}lat"), F.lit(","), F.col(f"{prefix}lon"))

    turned = C.heading_change(
        F.coalesce("track", F.lit(0)), F.coalesce("prev_track", F.lit(0)), wrap_heading
    )
    moved = (F.abs(F.col("lat") - F.col("prev_lat")) > thresholds.position) | (
        F.abs(F.col("lon") - F.col("prev_lon")) > thresholds.position
    )
    first = F.concat(F.lit("lat="), F.col("lat"), F.lit(",lon="), F.col("lon"))
    events = F.array(
        event("NEW", ~seen, F.lit(None), first),
        event("POSITION", seen & moved, place("prev_"), place("")),
        event("ALTITUDE", seen & (gap("alt_baro") > thresholds.altitude), F.col("prev_alt_baro"), F.col("alt_baro")),
        event("SPEED", seen & (gap("gs") > thresholds.speed), F.col("prev_gs"), F.col("gs")),
        event("HEADING", seen & (turned > thresholds.heading), F.col("prev_track"), F.col("track")),
    )
    return pairs.select(
        "hex",
        "callsign",
        F.explode(F.array_compact(events)).alias("e"),
        F.col("fetched_at").alias("event_at"),
        instant(as_of).alias("detected_at"),
    ).select("hex", "callsign", "e.*", "event_at", "detected_at")


def with_previous_state(batch: DataFrame, state: DataFrame) -> DataFrame:
    """A batch of clean rows plus, per key, the observation the state remembers.

    The state row of a key is its newest live observation before the batch, so
    :func:`cdc_long` on the result finds what it would find on the whole log.
    Keys that vanished have no live predecessor any more.
    """
    remembered = (
        state.filter("NOT (is_deleted AND deleted_reason <=> 'DISAPPEARED')")
        .join(live_keys(batch), "hex", "left_semi")
        .select(
            "hex", *MEASURES,
            F.col("last_seen_at").alias("fetched_at"),
            F.lit("").alias("ingestion_id"),
            F.lit(False).alias("is_deleted"),
        )
    )
    return batch.select(*remembered.columns).unionByName(remembered)


def live_keys(batch: DataFrame) -> DataFrame:
    return batch.filter("is_deleted = false").select("hex").distinct()


def cdc_wide(
    state: DataFrame,
    latest: DataFrame,
    thresholds: Thresholds = THRESHOLDS_L,
    as_of: datetime | None = None,
    null_as_zero: bool = False,
    wrap_heading: bool = False,
) -> DataFrame:
    """One row per key of ``latest`` against the state: the changes joined by '|'.

    NEW for an unknown key, UNCHANGED for no change. A NULL on either side is no
    change unless ``null_as_zero``.
    """
    names = ["lat", "lon", "altitude_ft", "gs_knots", "track_deg"]
    old = state.select(
        F.col("hex").alias("_old_hex"), *[F.col(n).alias(f"old_{n}") for n in names]
    )
    new = latest.select("hex", "flight", *[F.col(n).alias(f"new_{n}") for n in names])

    def side(prefix: str, name: str) -> Column:
        value = F.col(f"{prefix}_{name}")
        return F.coalesce(value, F.lit(0.0)) if null_as_zero else value

    def gap(name: str) -> Column:
        return F.abs(side("new", name) - side("old", name))

    moved = (gap("lat") > thresholds.position) | (gap("lon") > thresholds.position)
    turned = C.heading_change(side("new", "track_deg"), side("old", "track_deg"), wrap_heading)
    changes = F.concat_ws(
        "|",
        F.when(moved, "POSITION_CHANGE"),
        F.when(gap("altitude_ft") > thresholds.altitude, "ALT_CHANGE"),
        F.when(gap("gs_knots") > thresholds.speed, "SPEED_CHANGE"),
        F.when(turned > thresholds.heading, "HEADING_CHANGE"),
    )
    event = F.when(F.col("_old_hex").isNull(), "NEW").otherwise(
        F.coalesce(C.empty_to_null(changes), F.lit("UNCHANGED"))
    )
    values = [f"{side_}_{n}" for n in names for side_ in ("old", "new")]
    return new.join(old, F.col("hex") == F.col("_old_hex"), "left").select(
        F.concat_ws("_", "hex", iso_text(as_of)).alias("cdc_id"),
        "hex",
        "flight",
        event.alias("cdc_event"),
        *values,
        instant(as_of).alias("detected_at"),
    )


def cdc_mark(cdc: DataFrame) -> Column:
    """Newest event time logged so far, as a scalar subquery; 1970 if none."""
    epoch = instant(datetime(1970, 1, 1))
    return cdc.agg(F.coalesce(F.max("event_at"), epoch).alias("mark")).scalar()
