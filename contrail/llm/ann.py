"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by fast pseudo-rotations (random signs and a Hadamard
transform, three times) and hashed to their largest signed coordinate. Every
vector lies in one cell of each table; a query probes the cells of its largest
coordinates. Candidates are ranked exactly on the original vectors. For inner
products of vectors of different lengths, a further coordinate brings all of
them to the longest length first, which leaves the order of products as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.scratch import store
from contrail.llm.vectors import meet, usable

TABLES = 12
PROBES = 10  # of 128 cells; in proportion for other dimensions
SEED = 4


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of signs and a normalised Hadamard transform of the rows."""
    n, d = x.shape
    for sign in signs:
        x = x * sign
        step = 1
        while step < d:
            y = x.reshape(n, d // (2 * step), 2, step)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
            step *= 2
        x = x / np.sqrt(d)
    return x


def _best(q_ids, q, v_ids, v, k: int) -> pd.DataFrame:
    """The ``k`` largest inner products of each query, ties to the smaller id.

    A fast product only preselects, with room for its rounding; the scores are
    sums in one fixed order, so equal vectors get equal scores.
    """
    out: list[tuple] = []
    order = np.argsort(v_ids, kind="stable")
    v_ids, v = v_ids[order], v[order]
    for lo in range(0, len(q), 256):
        rough = q[lo : lo + 256] @ v.T
        rough[q_ids[lo : lo + 256, None] == v_ids[None, :]] = -np.inf
        scale = 1e-9 * (1 + np.abs(rough[np.isfinite(rough)]).max(initial=0))
        cut = np.partition(rough, max(0, rough.shape[1] - k), axis=1)[:, max(0, rough.shape[1] - k)]
        for i, row in enumerate(rough):
            near = np.flatnonzero((row >= cut[i] - scale) & np.isfinite(row))
            score = (v[near] * q[lo + i]).sum(axis=1)
            top = np.argsort(-score, kind="stable")[:k]
            out.append((np.full(len(top), q_ids[lo + i]), v_ids[near[top]], score[top]))
    return pd.DataFrame({c: np.concatenate(x) for c, x in zip(("query_id", "vec_id", "score"), zip(*out, strict=True), strict=True)})


def _search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    def answer(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        return _best(q["id"].to_numpy(), np.stack(q["vec"]), v["id"].to_numpy(), np.stack(v["vec"]), k)

    return meet(index, queries, answer, "query_id long, vec_id long, score double")


def nearest(
    df: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for each query.

    ``is_query`` is an SQL condition on ``id``. Vectors that are null, zero, or
    hold null or non-finite parts, rows without an id, and vectors of another
    than the commonest dimension take no part; repeated ids count once. A query
    never finds itself. A query whose cells hold fewer than ``k`` others is
    compared with every vector, so it gets all there are if there are fewer.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = store(usable(df, id_col, vector_col, nonzero=True), "vectors")
    norm2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    facts = rows.agg(
        F.max(norm2).alias("most"), F.min(norm2).alias("least"), F.max(F.size("vec")).alias("d"), F.count(F.lit(1)).alias("n")
    ).first()
    dim = facts["d"] or 1
    longest2 = facts["most"] or 1.0
    lift = facts["n"] > 0 and facts["least"] < 0.98 * longest2
    width = 1 << max(1, (dim + lift - 1).bit_length())
    probe = min(2 * width, max(1, round(probes * width / 64)))
    signs = np.random.default_rng(SEED).choice([-1.0, 1.0], (tables, 3, width))

    def cells(as_query: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if not len(b):
                    continue
                raw = np.stack(b["vec"])
                x = np.zeros((len(b), width))
                scale = np.sqrt((raw**2).sum(axis=1)) if as_query or not lift else np.full(len(b), np.sqrt(longest2))
                x[:, :dim] = raw / scale[:, None]
                if lift and not as_query:
                    x[:, dim] = np.sqrt(np.clip(1 - (x[:, :dim] ** 2).sum(axis=1), 0, None))
                for t in range(tables):
                    y = rotate(x, signs[t])
                    signed = np.concatenate([y, -y], axis=1)
                    if as_query:
                        chosen = np.argpartition(-signed, probe - 1, axis=1)[:, :probe]
                    else:
                        chosen = signed.argmax(axis=1)[:, None]
                    some = np.repeat(np.arange(len(b)), chosen.shape[1])
                    yield pd.DataFrame(
                        {"cell": t * 2 * width + chosen.ravel(), "id": b["id"].to_numpy()[some], "vec": b["vec"].to_numpy()[some]}
                    )

        return run

    shape = "cell int, id long, vec array<double>"
    queries = rows.filter(is_query)
    index = store(rows.mapInPandas(cells(False), shape), "cells")
    probed = store(queries.mapInPandas(cells(True), shape), "probes")
    found = store(_search(index, probed, k).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "found")

    # Queries with too few candidates meet every vector, in blocks.
    enough = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= k)
    short = store(queries.join(enough, F.col("id") == F.col("query_id"), "left_anti"), "short")
    if not short.isEmpty():
        whole = _search(rows.withColumn("cell", F.lit(0)), short.withColumn("cell", F.lit(0)), k)
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(whole)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
