"""Layer runs over stored tables: raw -> clean -> state, history, events -> marts.

One batch costs its own rows plus the state (one row per key); the logs behind
it are never rewritten. Vanished keys are recorded as marks that
:func:`read_clean` applies, instead of rewriting their old rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schemas
from contrail.functions import columns as C
from contrail.functions.time import instant
from contrail.operators import cdc as changes
from contrail.operators.clean import clean_observations, latest_observation, load_stats
from contrail.operators.keyed import latest_per_key, lookup
from contrail.operators.lifecycle import (
    GRACE_MINUTES,
    SUPPRESS_MINUTES,
    logged_recently,
    reactivate,
    vanish_rows,
    with_vanished,
)
from contrail.operators.scd2 import scd2_step
from contrail.operators.state import merge_current, restore, set_flagged_deleted, soft_delete
from contrail.plans import kpis, marts, rollups, routes
from contrail.sources.tables import NO_VERSION, Lake

_LIFE = T.StructField("life", T.IntegerType())
# ``life`` counts how often a key has vanished; ``vanished_in`` is the last batch it did.
# ``logged_at`` and ``logged_in`` are time and batch of its last DISAPPEARED event.
STATE_N = T.StructType(
    schemas.CURRENT_N.fields
    + [_LIFE, *schemas.struct("vanished_in BIGINT, logged_at TIMESTAMP, logged_in BIGINT").fields]
)
CLEAN_N = T.StructType(schemas.CLEAN_N.fields + [_LIFE])
PROGRESS = schemas.struct("mark TIMESTAMP")
LATEST_L = T.StructType(
    [f for f in schemas.CURRENT_L.fields if f.name not in ("last_seen", "updated_at")]
)

SILVER_N = ["raw", "clean", "marks", "current", "history", "cdc", "progress"]
SILVER_L = ["raw_l", "clean_l", "latest_l", "current_l", "history_l", "cdc_l"]
GOLD_N = ["metrics", "route_summary", "hotspots"]
GOLD_L = [
    "aircraft_dim", "airline_dim", "minute_metrics", "kpis", "region_summary", "top_operators",
    "hourly_trend",
]


def run_silver(
    lake: Lake,
    raw: DataFrame,
    batch_id: int,
    as_of: datetime,
    grace_minutes: int = GRACE_MINUTES,
    suppress_minutes: int = SUPPRESS_MINUTES,
    source: str | None = None,
    late: str = "drop",
) -> None:
    """Take one batch of raw observations (profile N) through to a commit.

    ``late`` says what becomes of rows at or below the high-water mark: ``drop``,
    ``keep`` (they are cleaned like the others) or ``quarantine`` (they go to the
    log ``late``). The commit counts them as ``late_rows`` in any case.

    Order: reactivate, clean, merge, mark vanished, versions, events. Reads only
    the version before ``batch_id``, so running a batch again gives the same.
    """
    if late not in ("drop", "keep", "quarantine"):
        raise ValueError(f"late must be drop, keep or quarantine, got {late!r}")
    before = lake.last_commit(before=batch_id)
    lake.write_log("raw", raw, batch_id)
    raw = lake.read_batch("raw", schemas.RAW_N, batch_id)
    state = lake.read_state("current", STATE_N, before)
    progress = lake.read_state("progress", PROGRESS, before)
    epoch = instant(datetime(1970, 1, 1))
    mark = progress.agg(F.coalesce(F.max("mark"), epoch).alias("mark"))
    behind = raw.filter(F.col("fetched_at") <= mark.scalar())
    fresh = raw if late == "keep" else raw.filter(F.col("fetched_at") > mark.scalar())
    if late == "quarantine":
        lake.write_log("late", behind, batch_id)

    # Only keys that have vanished before carry a life other than 0.
    lives = state.filter("life > 0").select("hex", "life")
    clean = lookup(clean_observations(fresh, "N", as_of=as_of), lives, ["hex"]).withColumn(
        "life", F.coalesce("life", F.lit(0))
    )
    lake.write_log("clean", clean.select(*CLEAN_N.names), batch_id)
    clean = lake.read_batch("clean", CLEAN_N, batch_id)

    woken, return_events = reactivate(state, fresh, as_of)
    merged = merge_current(woken, latest_observation(clean), as_of=as_of)
    # The time of a key's last event is part of the state, so the event log stays closed.
    logs = F.col("_gone") & ~logged_recently(fresh, suppress_minutes)
    noted = {
        "life": F.coalesce("life", F.lit(0)) + F.col("_gone").cast("int"),
        "vanished_in": F.when(F.col("_gone"), F.lit(batch_id)).otherwise(F.col("vanished_in")),
        "logged_at": F.when(logs, instant(as_of)).otherwise(F.col("logged_at")),
        "logged_in": F.when(logs, F.lit(batch_id)).otherwise(F.col("logged_in")),
    }
    flagged = with_vanished(merged, fresh, grace_minutes).withColumns(noted)
    new_state = set_flagged_deleted(flagged, "_gone", C.DISAPPEARED, as_of)
    lake.write_state("current", new_state.select(*STATE_N.names), batch_id)
    new_state = lake.read_state("current", STATE_N, batch_id)
    gone = new_state.filter(F.col("vanished_in") == batch_id)

    versions = scd2_step(
        _open_versions(lake, "history", schemas.HISTORY_N, before),
        new_state.filter("is_deleted = false"),
        "N",
        as_of,
    )
    _write_versions(lake, "history", versions, batch_id)

    events = (
        changes.cdc_long(changes.with_previous_state(clean, state), as_of=as_of)
        .unionByName(return_events)
        .unionByName(vanish_rows(gone.filter(F.col("logged_in") == batch_id), as_of))
    )
    lake.write_log("cdc", events.select(*schemas.CDC_N.names), batch_id)
    lake.write_log(
        "marks",
        gone.select("hex", (F.col("life") - 1).cast("int").alias("life"), "deleted_at"),
        batch_id,
    )
    reached = clean.agg(F.max("fetched_at").alias("mark")).unionByName(progress)
    lake.write_state("progress", reached.agg(F.max("mark").alias("mark")), batch_id)
    late_rows = behind.agg(F.count(F.lit(1)).alias("n")).scalar()
    lake.commit(batch_id, "BATCH", load_stats(clean).withColumn("late_rows", late_rows), as_of, source)


def soft_delete_keys(
    lake: Lake, keys: DataFrame, as_of: datetime, reason: str = "MANUAL"
) -> int:
    """Soft-delete keys in the stored state and close their versions; gives the new version."""

    def change(state: DataFrame, opened: DataFrame) -> tuple[DataFrame, DataFrame]:
        return soft_delete(state, opened, keys, reason, as_of)

    return _change_stored(lake, "SOFT_DELETE", change, keys, as_of)


def restore_keys(lake: Lake, keys: DataFrame, as_of: datetime) -> int:
    """Bring soft-deleted keys back in the stored state; closed versions stay closed."""

    def change(state: DataFrame, opened: DataFrame) -> tuple[DataFrame, DataFrame]:
        return restore(state, keys, as_of), opened

    return _change_stored(lake, "RESTORE", change, keys, as_of)


def _change_stored(lake: Lake, operation: str, change, keys: DataFrame, as_of: datetime) -> int:
    before = lake.last_commit()
    version = before + 1
    state, opened = change(
        lake.read_state("current", STATE_N, before),
        _open_versions(lake, "history", schemas.HISTORY_N, before),
    )
    lake.write_state("current", state, version)
    _write_versions(lake, "history", opened, version)
    lake.write_state("progress", lake.read_state("progress", PROGRESS, before), version)
    lake.commit(version, operation, keys.agg(F.count_distinct("hex").alias("keys")), as_of)
    return version


def _write_versions(lake: Lake, table: str, versions: DataFrame, version: int) -> None:
    """Open and just-closed versions of one step, in one pass."""
    versions.write.mode("overwrite").partitionBy("is_current").parquet(
        f"{lake.path(table)}/version={version}"
    )
    lake.mark(table, version)


def _open_versions(lake: Lake, table: str, schema: T.StructType, version: int) -> DataFrame:
    return lake.read_state(table, schema, version).filter("is_current")


def read_history(lake: Lake, table: str = "history", schema: T.StructType = schemas.HISTORY_N) -> DataFrame:
    """All closed versions plus the open ones of the last commit."""
    last = lake.latest(table)
    if last == NO_VERSION:
        return lake.empty(schema)
    with_version = T.StructType(schema.fields + [T.StructField("version", T.LongType())])
    rows = lake.spark.read.schema(with_version).parquet(lake.path(table))
    version = F.col("version")
    kept = (~F.col("is_current") & (version <= last)) | (F.col("is_current") & (version == last))
    return rows.filter(kept).select(*schema.names)


def read_clean(lake: Lake) -> DataFrame:
    """The clean log with the rows of vanished keys soft-deleted.

    A mark applies to the rows a key wrote in one of its lives, so each row
    meets at most one mark and the join is a plain equality.
    """
    rows = lake.read_log("clean", CLEAN_N)
    marks = lake.read_log("marks", schemas.MARKS).select(
        "hex", "life", F.col("deleted_at").alias("_marked_at")
    )
    hit = F.col("_marked_at").isNotNull() & ~F.col("is_deleted")
    changed = {
        "is_deleted": F.col("is_deleted") | F.col("_marked_at").isNotNull(),
        "deleted_at": F.when(hit, F.col("_marked_at")).otherwise(F.col("deleted_at")),
        "deleted_reason": F.when(hit, C.DISAPPEARED).otherwise(F.col("deleted_reason")),
    }
    return lookup(rows, marks, ["hex", "life"]).select(
        *[changed.get(n, F.col(n)).alias(n) for n in schemas.CLEAN_N.names]
    )


def read_current(lake: Lake) -> DataFrame:
    return lake.read_state("current", STATE_N).select(*schemas.CURRENT_N.names)


def run_silver_local(
    lake: Lake, raw: DataFrame, batch_id: int, as_of: datetime, source: str | None = None
) -> None:
    """Take one batch of raw observations (profile L) through to a commit.

    The newest observation per key is kept as state, so neither change events
    nor versions look at the clean log again.
    """
    before = lake.last_commit(before=batch_id)
    lake.write_log("raw_l", raw, batch_id)
    lake.write_log(
        "clean_l",
        clean_observations(lake.read_batch("raw_l", schemas.RAW_L, batch_id), "L"),
        batch_id,
    )
    clean = lake.read_batch("clean_l", schemas.CLEAN_L, batch_id)
    known = lake.read_state("latest_l", LATEST_L, before)
    arrived = latest_observation(clean, "L").select(*LATEST_L.names)
    lake.write_state(
        "latest_l",
        latest_per_key(
            known.withColumn("_new", F.lit(0)).unionByName(arrived.withColumn("_new", F.lit(1))),
            ["hex"],
            [F.desc("observed_at"), F.desc("_new")],
        ).drop("_new"),
        batch_id,
    )
    latest = lake.read_state("latest_l", LATEST_L, batch_id)

    current = lake.read_state("current_l", schemas.CURRENT_L, before)
    lake.write_log("cdc_l", changes.cdc_wide(current, latest, as_of=as_of), batch_id)
    versions = scd2_step(
        _open_versions(lake, "history_l", schemas.HISTORY_L, before), latest, "L", as_of
    )
    _write_versions(lake, "history_l", versions, batch_id)
    opened = _open_versions(lake, "history_l", schemas.HISTORY_L, batch_id)
    lake.write_state(
        "current_l",
        opened.select(
            "hex", *schemas.ATTRIBUTES_L,
            F.col("effective_from").alias("last_seen"),
            F.col("effective_from").alias("updated_at"),
            "observed_at",
        ),
        batch_id,
    )
    lake.commit(batch_id, "BATCH", clean.agg(F.count(F.lit(1)).alias("rows")), as_of, source)


def gold_n(current: DataFrame, clean: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    return {
        "metrics": kpis.kpi_snapshot(current, clean, as_of),
        "route_summary": kpis.route_summary(clean, as_of),
        "hotspots": kpis.hotspots(current, as_of=as_of),
    }


def gold_l(current: DataFrame, clean: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    return {
        "aircraft_dim": marts.aircraft_dim(clean, as_of),
        "airline_dim": marts.airline_dim(clean, as_of),
        "minute_metrics": marts.minute_metrics(clean),
        "kpis": marts.kpis(current, as_of),
        "region_summary": marts.region_summary(current, clean, as_of),
        "top_operators": marts.top_operators(clean, as_of=as_of),
        "hourly_trend": marts.hourly_trend(clean),
    }


def run_gold(lake: Lake, as_of: datetime, profile: str = "N") -> list[str]:
    """Write the marts of the last commit from the whole log.

    Metrics and routes accumulate, the rest is replaced.
    """
    version = lake.last_commit()
    if profile == "N":
        made = gold_n(read_current(lake), read_clean(lake), as_of)
    else:
        made = gold_l(
            lake.read_state("current_l", schemas.CURRENT_L),
            lake.read_log("clean_l", schemas.CLEAN_L),
            as_of,
        )
    for name, df in made.items():
        if name in ("metrics", "route_summary"):
            lake.write_log(name, df, version)
        else:
            lake.write_state(name, df, version)
    return list(made)


class _Carry:
    """State tables brought to a version, each from its own last version and the batches since.

    A run that died half way has written some tables and not others. So every
    table goes by itself: what a table has is never added again, and what it
    lacks is not lost, whichever commits were skipped.
    """

    def __init__(self, lake: Lake, version: int):
        self.lake, self.version = lake, version

    def before(self, table: str) -> int:
        return self.lake.latest(table, self.version - 1)

    def batches(self, table: str, log: str, schema: T.StructType) -> DataFrame:
        """Rows of a log that the table has not seen."""
        return self.lake.read_batches(log, schema, self.before(table), self.version)

    def known(self, table: str, schema: T.StructType) -> DataFrame:
        return self.lake.read_state(table, schema, self.before(table))

    def write(self, table: str, df: DataFrame) -> DataFrame:
        self.lake.write_state(table, df, self.version)
        return self.lake.read_state(table, df.schema, self.version)


def update_gold(lake: Lake, as_of: datetime) -> list[str]:
    """The profile N marts of the last commit, from the last ones and all batches since.

    It gives what :func:`run_gold` gives. Routes follow by signed deltas, so
    neither the clean log nor earlier marks are read. The deltas of a version are
    stored before the totals take them.
    """
    carry = _Carry(lake, lake.last_commit())
    known = carry.known("route_lives", routes.LIVES)
    batch = carry.batches("route_lives", "clean", CLEAN_N)
    marks = carry.batches("route_lives", "marks", schemas.MARKS)
    folded = routes.fold_lives(known, batch, marks)
    lake.write_log("route_deltas", routes.route_deltas(known, batch, folded), carry.version)
    lives = carry.write("route_lives", folded.filter("NOT fallen").drop("fallen"))
    # Deltas of a run that died before its lives were written are made again with the next ones.
    whole = [v for v in lake.versions("route_lives") if carry.before("route_totals") < v <= carry.version]
    deltas = lake.read_log("route_deltas", routes.DELTAS, carry.version).filter(F.col("batch_id").isin(whole)).drop("batch_id")
    totals = carry.write("route_totals", routes.apply_deltas(carry.known("route_totals", routes.TOTALS), deltas, lives))
    current = read_current(lake)
    made = {
        "metrics": kpis.kpi_snapshot_of(current, routes.route_frequency(totals), as_of),
        "route_summary": routes.route_summary(totals, as_of),
        "hotspots": kpis.hotspots(current, as_of=as_of),
    }
    for name, df in made.items():
        if name == "hotspots":
            lake.write_state(name, df, carry.version)
        else:
            lake.write_log(name, df, carry.version)
    return list(made)


def update_gold_local(lake: Lake, as_of: datetime) -> list[str]:
    """The profile L marts of the last commit, from the last ones and all batches since.

    It gives what :func:`run_gold` gives, whichever commits it was called for and
    wherever an earlier call died.
    """
    carry = _Carry(lake, lake.last_commit())
    log = lake.read_log("clean_l", schemas.CLEAN_L).drop("batch_id")
    current = lake.read_state("current_l", schemas.CURRENT_L)

    def merged(table: str, schema: T.StructType, merge) -> DataFrame:
        return carry.write(table, merge(carry.known(table, schema), carry.batches(table, "clean_l", schemas.CLEAN_L)))

    def refreshed(table: str, unit: str, time: str, build) -> DataFrame:
        if carry.before(table) == NO_VERSION:
            return build(log)  # every bucket is new, so none has to be looked up
        known = carry.known(table, build(log).schema)
        return rollups.refresh_buckets(known, log, carry.batches(table, "clean_l", schemas.CLEAN_L), unit, time, build)

    operators = merged("operator_totals", rollups.OPERATORS, rollups.merge_operators)
    types = merged("type_counts", rollups.TYPES, rollups.merge_types)
    aircraft = merged("aircraft_totals", rollups.AIRCRAFT, rollups.merge_aircraft)
    airlines = rollups.airline_dim(operators, as_of)
    made = {
        "aircraft_dim": rollups.aircraft_dim(aircraft, as_of),
        "airline_dim": airlines,
        "minute_metrics": refreshed("minute_metrics", "minute", "metric_time", marts.minute_metrics),
        "kpis": marts.kpis(current, as_of),
        "region_summary": marts.region_summary_of(current, types, as_of),
        "top_operators": marts.rank_operators(
            airlines.withColumnRenamed("callsign_prefix", "operator"), as_of=as_of
        ),
        "hourly_trend": refreshed("hourly_trend", "hour", "hour_bucket", marts.hourly_trend),
    }
    for name, df in made.items():
        lake.write_state(name, df, carry.version)
    return list(made)


def run_all(
    spark: SparkSession, root: str, raw: DataFrame, batch_id: int, as_of: datetime, profile: str = "N"
) -> Lake:
    """One whole cycle over a batch."""
    lake = Lake(spark, root)
    if profile == "N":
        run_silver(lake, raw, batch_id, as_of)
    else:
        run_silver_local(lake, raw, batch_id, as_of)
    if profile == "N":
        update_gold(lake, as_of)
    else:
        update_gold_local(lake, as_of)
    return lake
