"""What the plans must look like at scale: prunings, group limits, split hot keys."""

from __future__ import annotations

import re

import pytest
from conftest import NOW, T0
from pyspark.sql import functions as F

from contrail import registry, schemas
from contrail.operators import cdc, clean, keyed, lifecycle
from contrail.plans import kpis, marts, quality, serving

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan AQE ended with."""
    df._jdf.queryExecution().toRdd().count()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A raw table on disk, as the operators meet it."""
    where = str(tmp_path_factory.mktemp("plans") / "raw")
    registry._raw(spark, SF).write.parquet(where)
    return spark.read.schema(schemas.RAW_N).parquet(where)


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_latest_sends_one_row_per_key_and_task(stored):
    text = plan(clean.latest_observation(clean.clean_observations(stored, "N", as_of=NOW)))
    limit = text.index("Partial")
    assert "WindowGroupLimit" in text and text.index("Exchange hashpartitioning(hex") < limit


def test_previous_reuses_the_shuffle_of_latest(stored):
    rows = clean.clean_observations(stored, "N", as_of=NOW)
    alone = plan(clean.latest_observation(rows)).count("Exchange")
    assert plan(cdc.cdc_long(rows, as_of=NOW)).count("Exchange") == alone


def test_duplicates_read_narrow_columns_first(stored):
    schemas_read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(keyed.flag_duplicates(stored).select("raw_payload", "is_duplicate")))
    narrow = [s for s in schemas_read if "raw_payload" not in s]
    assert narrow and all("callsign" not in s and "lat" not in s for s in narrow)


def test_few_duplicates_mean_no_wide_shuffle(stored):
    text = final_plan(keyed.flag_duplicates(stored))
    assert "BroadcastHashJoin" in text


def test_mark_reaches_the_scan(stored):
    marked = clean.clean_observations(stored, "N", since=T0)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(fetched_at", plan(marked))


def test_latest_poll_reaches_the_scan(stored):
    text = plan(lifecycle.keys_in_latest_fetch(stored))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(fetched_at,ScalarSubquery", text)
    assert "ReadSchema: struct<fetched_at:timestamp,hex:string>" in text


def test_hot_key_is_split(spark, no_broadcast):
    """A third of the rows share one (key, poll); the join back splits that partition."""
    hot = F.col("id") % 3 == 0
    df = spark.range(0, 120000, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("h"), (F.col("id") / 2).cast("bigint"))).alias("hex"),
        F.lit(T0).alias("fetched_at"),
        (F.col("id") % 50 / 2).alias("seen"),
        F.col("id").cast("string").alias("ingestion_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("raw_payload"),
    )
    flagged = keyed.flag_duplicates(df)
    assert "skew=true" in final_plan(flagged)
    assert flagged.filter("hex = 'hot' AND NOT is_duplicate").count() == 1


def test_no_python_no_products_no_single_partition_sorts(spark):
    for name in ("hotspots", "kpi_snapshot", "cdc_long", "scd2_l", "minute_metrics", "disappearance_by_minute",
                 "top_callsigns", "key_history", "change_feed", "latest_scalars", "growth_day_over_day"):
        text = plan(registry.QUERIES[name](spark, SF))
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|ArrowEvalPython|BatchEvalPython|MapInPandas", text), name


def test_top_lists_do_not_sort_everything(stored):
    rows = clean.clean_observations(stored, "N", as_of=NOW)
    for df in (kpis.route_frequency(rows), quality.newest_rows(stored)):
        assert "TakeOrderedAndProject" in plan(df)


def test_rank_is_taken_over_the_top_rows_only(spark):
    text = plan(marts.top_operators(registry._clean_l(spark, SF)))
    assert text.index("Window") < text.index("TakeOrderedAndProject")


def test_ties_without_a_global_window(spark):
    current = spark.createDataFrame([], schemas.CURRENT_L)
    assert "Window" not in plan(serving.top_callsigns(current))


def test_state_columns_only(stored):
    """Hotspots read eight of the 27 raw columns, not the payload."""
    rows = clean.clean_observations(stored, "N", as_of=NOW)
    text = plan(kpis.route_summary(rows))
    assert "raw_payload" not in text and "nav_modes" not in text
