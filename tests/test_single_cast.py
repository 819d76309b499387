"""Texts that cost an exception or a JSON parser are read once, or not at all where a plain cut does."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail import schemas, testbed
from contrail.operators import clean

ALTITUDES = {"ground": (0.0, True, False), "bad": (None, False, None), "-600": (None, False, True), "120": (120.0, False, False), None: (None, None, None)}


def test_altitude_text_is_cast_once(spark):
    raw = spark.createDataFrame([("h1",)], "hex string").select(
        *[(F.col("hex") if f.name == "hex" else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.RAW_L.fields if f.name != "alt_baro"]
    )
    raw = raw.crossJoin(spark.createDataFrame([(a,) for a in ALTITUDES], "alt_baro string"))
    rows = clean.clean_observations(raw.select(*schemas.RAW_L.names), "L")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(alt_baro") == 1  # four times where it was not a column
    got = sorted(map(str, rows.select("altitude_ft", "on_ground", "dq_bad_alt").collect()))
    assert got == sorted(str(r) for r in spark.createDataFrame(list(ALTITUDES.values()), "altitude_ft double, on_ground boolean, dq_bad_alt boolean").collect())


def test_usual_props_are_not_parsed(spark):
    texts = ['{"k": 5}', '{"k":0}', '{"k": 05}', '{"k": -3}', '{"k": 1234567890}', ' {"k": 7}', '{"j": 1, "k": 2}', '{"k": "12"}', '{"k": null}', "{}", "", None, "x"]
    rows = spark.createDataFrame([(t,) for t in texts], "props string")
    assert "RLIKE" in testbed._BASE["k"]
    same = rows.filter(~F.expr(testbed._BASE["k"]).eqNullSafe(F.expr("cast(get_json_object(props, '$.k') AS int)")))
    assert same.isEmpty()
