"""Per-key building blocks that survive a key holding much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

_JOIN_HASH = "_key_hash"


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str = "rn"
) -> DataFrame:
    """The first ``n`` rows of each key, numbered from 1.

    A ``row_number() <= n`` filter is pushed below the shuffle as a group limit:
    every map task sends at most ``n`` rows per key, however large the key is.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col(rank) <= n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1, "_rn").drop("_rn")


def latest_with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """The newest row per key plus ``prev_<column>`` of the one before.

    ``has_prev`` tells a missing predecessor from NULL values. The second window
    reuses the partitioning and sort of the first.
    """
    top = top_per_key(df, keys, order, 2, "_rn")
    window = Window.partitionBy(*keys).orderBy(*order)
    shifted = top.select(
        "*",
        *[F.lead(c).over(window).alias(f"prev_{c}") for c in columns],
        F.lead(F.lit(True), 1, False).over(window).alias("has_prev"),
    )
    return shifted.filter("_rn = 1").drop("_rn")


def lookup(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a possibly skewed frame with one that has a single row per key.

    Not hinted: AQE broadcasts the small side only after measuring it. The extra
    hash column makes both sides shuffle for this very join, which is what lets
    AQE split a hot key's partition when the small side is too big to broadcast.
    """
    tagged = F.xxhash64(*keys)
    left = big.withColumn(_JOIN_HASH, tagged)
    right = small.withColumn(_JOIN_HASH, tagged)
    return left.join(right, [_JOIN_HASH, *keys], how).drop(_JOIN_HASH)


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str] = ("hex", "fetched_at"),
    prefer: str = "seen",
    row_id: str = "ingestion_id",
    flag: str = "is_duplicate",
) -> DataFrame:
    """Mark every row but the best of its key; ``row_id`` must be unique.

    Best is the smallest ``prefer``, NULL last, then the smallest ``row_id``.
    Keys that occur once need no ranking. So the narrow columns are aggregated
    with map-side combine, and only keys with several rows are joined back:
    the wide rows are not shuffled unless duplicates are many.
    """
    standing = F.struct(F.col(prefer).isNull().alias("missing"), prefer, row_id)
    repeated = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_copies"), F.min(standing).alias("_best"))
        .filter("_copies > 1")
        .drop("_copies")
    )
    joined = lookup(df, repeated, keys)
    return joined.withColumn(flag, F.coalesce(standing > F.col("_best"), F.lit(False))).drop("_best")
