"""The route marts of profile N kept up to date by signed deltas.

A clean row counts until its key vanishes: the mark of (key, life) then takes all
rows of that life out again. So the library keeps, per route and life, what those
rows add up to. A batch adds its rows as positive deltas; a mark takes its lives
out as negative ones. Counts and sums of a route change by the deltas alone.
Extremes and regions cannot be subtracted: where a life falls they are taken anew
from the lives that are left, elsewhere they only widen. Neither the log nor the
marks of earlier batches are read.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import schemas
from contrail.functions import columns as C
from contrail.functions.time import instant
from contrail.operators.clean import live
from contrail.operators.keyed import lookup
from contrail.plans.kpis import TOP_ROUTES

ROUTE = ["callsign", "airline_icao", "aircraft_type"]
LIFE = ["hex", "life"]
_SUMS = ["total_observations", "altitude_sum", "altitude_n", "speed_sum", "speed_n"]
_LEAST, _MOST = ["min_lat", "min_lon"], ["max_lat", "max_lon"]
_MEASURES = (
    "total_observations BIGINT, altitude_sum BIGINT, altitude_n BIGINT, speed_sum BIGINT, speed_n BIGINT, "
    "min_lat DOUBLE, max_lat DOUBLE, min_lon DOUBLE, max_lon DOUBLE, regions ARRAY<STRING>"
)
_ROUTE = ", ".join(f"{n} STRING" for n in ROUTE)
LIVES = schemas.struct(f"hex STRING, life INT, {_ROUTE}, {_MEASURES}")
TOTALS = schemas.struct(f"{_ROUTE}, {_MEASURES}")
DELTAS = schemas.struct(f"{_ROUTE}, {_MEASURES}, shrinks BOOLEAN")


def _added() -> list[Column]:
    """Measures of groups of measures."""
    regions = F.array_sort(F.array_distinct(F.flatten(F.collect_set("regions"))))
    return [
        *[F.sum(n).alias(n) for n in _SUMS], *[F.min(n).alias(n) for n in _LEAST],
        *[F.max(n).alias(n) for n in _MOST], regions.alias("regions"),
    ]


def life_parts(clean: DataFrame) -> DataFrame:
    """Live clean rows with a callsign, added up per route and life."""
    named = live(clean).filter(F.col("callsign") != C.NO_CALLSIGN)
    # Whole thousandths of a knot add up and subtract exactly; feeds give tenths.
    speed = F.round(F.col("gs") * 1000).cast("bigint")
    return named.groupBy(*LIFE, *ROUTE).agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.coalesce(F.sum("alt_baro"), F.lit(0)).alias("altitude_sum"),
        F.count("alt_baro").alias("altitude_n"),
        F.coalesce(F.sum(speed), F.lit(0)).alias("speed_sum"),
        F.count("gs").alias("speed_n"),
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
        F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
        F.array_sort(F.collect_set("source_region")).alias("regions"),
    ).select(*LIVES.names)


def fold_lives(known: DataFrame, batch: DataFrame, marks: DataFrame) -> DataFrame:
    """The lives after a batch, with the fallen ones flagged ``fallen``.

    ``known`` holds the lives before, ``batch`` the batch's clean rows with
    their ``life``, ``marks`` (hex, life) the lives that ended with it. A life
    may fall in the batch that wrote its last rows.
    """
    both = known.select(*LIVES.names).unionByName(life_parts(batch))
    merged = both.groupBy(*LIFE, *ROUTE).agg(*_added())
    ended = marks.select(*LIFE).distinct().withColumn("fallen", F.lit(True))
    return lookup(merged, ended, LIFE).withColumn("fallen", F.coalesce("fallen", F.lit(False)))


def route_deltas(known: DataFrame, batch: DataFrame, folded: DataFrame) -> DataFrame:
    """Signed deltas per route; ``shrinks`` tells that a life was taken out.

    What a fallen life takes out is all it ever added, so it is the life's sum
    with a minus sign, next to what the batch adds to it.
    """
    plus = life_parts(batch).select(*TOTALS.names, F.lit(1).alias("sign"))
    minus = folded.filter("fallen").select(*TOTALS.names, F.lit(-1).alias("sign"))
    grows = F.col("sign") > 0
    kept = {n: F.when(grows, F.col(n)) for n in (*_LEAST, *_MOST, "regions")}
    signed = {n: F.col(n) * F.col("sign") for n in _SUMS}
    rows = plus.unionByName(minus).select(
        *ROUTE, *[(signed | kept)[n].alias(n) for n in TOTALS.names if n not in ROUTE], "sign"
    )
    return rows.groupBy(*ROUTE).agg(*_added(), (F.min("sign") < 0).alias("shrinks"))


def _same_route(left: str, right: str) -> Column:
    """Airline and type may be NULL, which is a route of its own."""
    out = F.lit(True)
    for n in ROUTE:
        out = out & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return out


def apply_deltas(totals: DataFrame, deltas: DataFrame, lives: DataFrame) -> DataFrame:
    """The route totals after a batch. ``lives`` are those still standing.

    Only routes from which a life fell look at their lives; routes without
    observations left go.
    """
    summed = totals.withColumn("shrinks", F.lit(False)).unionByName(deltas).groupBy(*ROUTE).agg(
        *_added(), F.bool_or("shrinks").alias("shrinks")
    ).filter("total_observations > 0")
    wide = [*_LEAST, *_MOST, "regions"]
    shrunk = summed.filter("shrinks").select(*ROUTE)
    left = lives.alias("l").join(shrunk.alias("s"), _same_route("l", "s"), "left_semi")
    anew = left.groupBy(*ROUTE).agg(*[c for c, n in zip(_added(), [*_SUMS, *_LEAST, *_MOST, "regions"], strict=True) if n in wide])
    joined = summed.alias("t").join(anew.alias("a"), _same_route("t", "a"), "left")
    return joined.select(
        *[f"t.{n}" for n in ROUTE + _SUMS],
        *[F.when(F.col("t.shrinks"), F.col(f"a.{n}")).otherwise(F.col(f"t.{n}")).alias(n) for n in wide],
    ).select(*TOTALS.names)


def route_summary(totals: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The mart :func:`contrail.plans.kpis.route_summary` makes from the log."""
    return totals.select(
        *ROUTE, "total_observations",
        F.round(F.try_divide("altitude_sum", "altitude_n"), 0).alias("avg_altitude"),
        F.round(F.try_divide(F.col("speed_sum") / 1000, F.col("speed_n")), 1).alias("avg_speed"),
        "min_lat", "max_lat", "min_lon", "max_lon",
        F.array_join("regions", ", ").alias("regions_seen"), instant(as_of).alias("computed_at"),
    )


def route_frequency(totals: DataFrame, k: int = TOP_ROUTES) -> DataFrame:
    """The commonest callsigns, as :func:`contrail.plans.kpis.route_frequency` finds them in the log."""
    counted = totals.groupBy(F.col("callsign").alias("dimension_value")).agg(
        F.sum("total_observations").cast("double").alias("metric_value")
    )
    return (
        counted.select(F.lit("route_frequency").alias("metric_name"), F.lit("callsign").alias("dimension"), "dimension_value", "metric_value")
        .orderBy(F.desc("metric_value"), "dimension_value")
        .limit(k)
    )
