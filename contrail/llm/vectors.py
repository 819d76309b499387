"""Vector tables: usable rows, and searches in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096  # rows of one side of a block


def usable(df: DataFrame, id_col: str, vector_col: str, nonzero: bool) -> DataFrame:
    """(id, vec): rows with an id and a vector of finite numbers, of the commonest dimension.

    ``nonzero`` leaves vectors of zeros out. Rows that repeat an id count once
    (the smallest vector stays).
    """
    vec = F.col(vector_col).cast("array<double>")
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(
        F.col("id").isNotNull() & F.col("vec").isNotNull()
    ).filter(good & (F.size("vec") > 0))
    if nonzero:
        rows = rows.filter(F.exists("vec", lambda x: x != 0))
    rows = rows.groupBy("id").agg(F.min("vec").alias("vec"))
    common = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1)
    # One row.
    return rows.join(F.broadcast(common.select("d")), F.size("vec") == F.col("d"), "left_semi")


def meet(
    index: DataFrame, queries: DataFrame, answer: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """``answer(queries, vectors)`` for groups in which each pair of a cell meets once.

    Both have (cell, id, vec, ...). A cell is cut to blocks on either side, so
    no group is larger than about two blocks whatever a cell holds. A task's
    batch takes several small groups.
    """
    sizes = (
        index.groupBy("cell").agg(F.count(F.lit(1)).alias("nv"))
        .join(queries.groupBy("cell").agg(F.count(F.lit(1)).alias("nq")), "cell")
        .select(
            "cell", "nv", "nq", F.ceil(F.col("nv") / BLOCK).cast("int").alias("vbs"), F.ceil(F.col("nq") / BLOCK).cast("int").alias("qbs")
        )
    )
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.join(sizes, "cell").withColumn("query", F.lit(False)).withColumn("vb", own("vbs")).withColumn("qb", every("qbs"))
    right = queries.join(sizes, "cell").withColumn("query", F.lit(True)).withColumn("qb", own("qbs")).withColumn("vb", every("vbs"))
    rows = left.drop("vbs", "qbs", "nv", "nq").unionByName(right.drop("vbs", "qbs", "nv", "nq"), allowMissingColumns=True)
    total = sizes.agg(F.sum(F.col("nv") * F.col("qbs") + F.col("nq") * F.col("vbs"))).first()[0] or 0
    batches = max(1, -(-int(total) // (2 * BLOCK)))
    rows = rows.withColumn("batch", F.pmod(F.xxhash64("cell", "vb", "qb"), F.lit(batches)))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        def each() -> Iterator[pd.DataFrame]:
            for _, part in g.groupby(["cell", "vb", "qb"], sort=True):
                part = part.sort_values("id", kind="stable")
                asks = part["query"].to_numpy()
                if asks.any() and not asks.all():
                    yield answer(part[asks], part[~asks])

        names = [c.split()[0] for c in schema.split(", ")]
        found = list(each())
        return pd.concat(found) if found else pd.DataFrame(columns=names)

    return rows.groupBy("batch").applyInPandas(run, schema)
