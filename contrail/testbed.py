"""Observations derived from the generic ``events`` table.

Plain arithmetic on the event columns, so that SQL can repeat it. It yields
every case the rules care about: ground and unreadable altitudes, bad
positions, blank callsigns, repeated (key, poll) rows, changing identities.
All fractions are binary, hence sums and text forms are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import schemas


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


_BASE = {
    # The usual text, {"k": 12}, is cut; only other texts are parsed as JSON, which costs several times as much.
    "k": (
        "cast(CASE WHEN props RLIKE r'\\A\\{\"k\": ?(0|[1-9][0-9]{0,8})\\}\\z' THEN trim(BOTH '{\"k: }' FROM props) "
        "ELSE get_json_object(props, '$.k') END AS int)"
    ),
    "event_ts": "cast(ts AS timestamp)",
    "ingestion_id": "lpad(cast(event_id AS string), 14, '0')",
    "hex": "concat('h', cast(user_id AS string))",
    "region": "element_at(array('delhi', 'mumbai', 'hyderabad', 'bangalore'), cast(k % 4 + 1 AS int))",
    "flight": (
        "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 11 = 0 THEN '   ' ELSE concat("
        "element_at(array('ai', 'SG', 'IGO', 'uae', 'B'), cast(user_id % 5 + 1 AS int)), "
        "cast(cast(user_id % 50 + k % 2 AS int) AS string), '  ') END"
    ),
    "lat": "CASE WHEN event_id % 41 = 0 THEN NULL ELSE (event_id * 37 % 1600) / 8.0D - 100 END",
    "lon": "(event_id * 53 % 3200) / 8.0D - 200",
    "alt_text": (
        "CASE WHEN k % 17 = 0 THEN 'ground' WHEN k % 19 = 0 THEN 'bad' WHEN k % 23 = 0 THEN NULL "
        "ELSE cast(k * 700 - 1400 AS string) END"
    ),
    "gs": (
        "CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN -1.0D "
        "ELSE floor(value * 16) / 4.0D END"
    ),
    "track": "cast(event_id * 17 % 360 AS double)",
    "baro_rate": "cast((event_id % 41 - 20) * 64 AS int)",
    "squawk": (
        "CASE WHEN event_type = 'error' AND k % 5 = 0 THEN '7700' WHEN k % 7 = 0 THEN NULL "
        "ELSE lpad(cast(1000 + k * 11 AS string), 4, '0') END"
    ),
    "emergency": (
        "CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error' AND k % 3 = 0 "
        "THEN 'general' WHEN event_type = 'view' AND k % 2 = 0 THEN '' ELSE 'none' END"
    ),
    "registration": "CASE WHEN user_id % 6 = 0 THEN NULL ELSE concat('vt-', cast(user_id AS string)) END",
    "aircraft_type": (
        "element_at(array('b738', 'a20n', 'at76', NULL), "
        "cast((user_id + CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END) % 4 + 1 AS int))"
    ),
    "category": "concat('A', cast(user_id % 6 AS string))",
    "seen": "CASE WHEN event_id % 23 = 0 THEN NULL ELSE (event_id * 7 % 64) / 8.0D END",
    "db_flags": "CASE WHEN user_id % 9 = 0 THEN NULL ELSE cast(user_id % 4 AS int) END",
}
# Columns kept under their own name in a projection that needs others first.
_FIRST = ("k",)


def _base(events: DataFrame) -> DataFrame:
    with_k = events.select("*", *[F.expr(_BASE[n]).alias(n) for n in _FIRST])
    derived = [F.expr(sql).alias(n) for n, sql in _BASE.items() if n not in _FIRST]
    return with_k.select("event_id", "k", *derived)


def raw_n(events: DataFrame) -> DataFrame:
    """Raw observations of profile N; a poll is an hour, repeats are natural."""
    picked = {
        "fetched_at": F.date_trunc("hour", "event_ts"),
        "source_region": F.col("region"),
        "alt_baro": F.when(F.col("alt_text").rlike(r"^-?\d+$"), F.col("alt_text").try_cast("int")),
    }
    base = _base(events)
    out = []
    for field in schemas.RAW_N.fields:
        value = picked.get(field.name)
        if value is None:
            value = F.col(field.name) if field.name in base.columns else F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return base.select(*out)


def raw_l(events: DataFrame) -> DataFrame:
    """Raw observations of profile L; keys come in mixed case with blanks."""
    untidy = F.concat(F.lit(" "), F.upper("hex"), F.lit(" "))
    picked = {
        "hex": F.when(F.col("event_id") % 7 == 0, untidy).otherwise(F.col("hex")),
        "flight": F.nullif(F.trim("flight"), F.lit("")),
        "alt_baro": F.col("alt_text"),
        "_region": F.col("region"),
        "_region_label": F.initcap("region"),
        "_ingested_at": F.col("event_ts"),
        "_loaded_at": F.date_trunc("hour", "event_ts"),
    }
    base = _base(events)
    out = []
    for field in schemas.RAW_L.fields:
        value = picked.get(field.name)
        if value is None:
            value = F.col(field.name) if field.name in base.columns else F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return base.select(*out)


DOCUMENT_SIZE = 200


def snapshot_documents(events: DataFrame, size: int = DOCUMENT_SIZE) -> DataFrame:
    """(region, document) text: API-envelope snapshots of at most ``size`` elements.

    Elements are grouped by a range of event ids within a region, so no document
    grows with the data.
    """
    base = _base(events)
    element = F.to_json(
        F.struct(
            "hex", "flight", "lat", "lon", F.col("alt_text").alias("alt_baro"), "gs", "track",
            "baro_rate", "squawk", "emergency", "category", F.col("registration").alias("r"),
            F.col("aircraft_type").alias("t"), "seen", F.col("db_flags").alias("dbFlags"),
        )
    )
    part = F.floor(F.col("event_id") / size).cast("bigint")
    return (
        base.groupBy("region", part.alias("part"))
        .agg(
            F.unix_millis(F.min(F.date_trunc("second", "event_ts"))).alias("now"),
            F.array_join(F.collect_list(element), ",").alias("elements"),
            F.count(F.lit(1)).alias("total"),
        )
        .select(
            "region",
            F.concat(
                F.lit('{"now":'), "now", F.lit(',"total":'), "total", F.lit(',"ac":['), "elements",
                F.lit("]}"),
            ).alias("document"),
        )
    )
