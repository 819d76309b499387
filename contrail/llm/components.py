"""Connected components by contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.scratch import store


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("a", "b")).alias("node"))


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges(a, b)``; component is its smallest node.

    In each round every node points to the lowest of its neighbours and itself,
    follows the pointers three steps, and edges follow. Pointers go down, so
    they never form a cycle. Even rounds rank nodes by themselves, which ends
    stars and trees that hang on small nodes at once; odd rounds rank by a seeded hash,
    so that the expected number of rounds is logarithmic for any numbering. Hubs
    only meet pre-aggregated minima and equality joins, so their partitions can
    be split. Null ends and loops are dropped; nodes without an edge have no row.
    """
    live = store(
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b").distinct(), "edges"
    )
    moved = _ends(live).distinct().withColumn("at", F.col("node"))
    turn = 0
    while not live.isEmpty():
        salt = F.lit(turn)
        order = (lambda c, s=salt: F.xxhash64(s, c)) if turn % 2 else (lambda c: F.lit(0).cast("long"))
        rank = lambda c, o=order: F.struct(o(c).alias("h"), c.alias("to"))
        near = live.select("a", "b").unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = store(
            near.groupBy("a")
            .agg(F.min(rank(F.col("b"))).alias("best"))
            .select(
                F.col("a").alias("from"),
                F.least(F.col("best"), rank(F.col("a"))).getField("to").alias("to"),
            ),
            "steps",
        )
        goes = step
        for _ in range(2):
            onward = step.select(F.col("from").alias("to"), F.col("to").alias("then"))
            goes = goes.join(onward, "to").select("from", F.col("then").alias("to"))
        goes = store(goes, "goes")
        moved = moved.join(goes, moved["at"] == goes["from"], "left").select(
            "node", F.coalesce("to", "at").alias("at")
        )
        first = goes.select(F.col("from").alias("a"), F.col("to").alias("x"))
        second = goes.select(F.col("from").alias("b"), F.col("to").alias("y"))
        live = store(
            live.join(first, "a").join(second, "b").filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
        turn += 1
        if turn % 4 == 0:
            moved = store(moved, "nodes")
    moved = store(moved, "nodes")
    least = moved.groupBy("at").agg(F.min("node").alias("component"))
    return store(moved.join(least, "at").select("node", "component"), "components")


def extended(at: DataFrame, more: DataFrame) -> DataFrame:
    """The components ``at`` after the edges ``more(a, b)`` are added to their graph."""
    place = lambda c: at.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    bridges = (
        more.join(place("a"), "a", "left").join(place("b"), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    )
    joined = connected(bridges).select(F.col("node").alias("component"), F.col("component").alias("least"))
    fresh = _ends(more).withColumn("component", F.col("node"))
    # A component's name is its smallest node, so the lower one is the old place.
    nodes = at.unionByName(fresh).groupBy("node").agg(F.min("component").alias("component"))
    return store(
        nodes.join(joined, "component", "left").select("node", F.coalesce("least", "component").alias("component")),
        "components",
    )
