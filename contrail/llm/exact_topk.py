"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length. A query first gets a bound from a block of the
longest ones: no answer is below its k-th score there. In every group the bound
becomes a cosine that an answer must reach with the group's longest vector. A
group that cannot reach it is skipped; where the cosine is high, the query's
largest coordinates limit those of an answer (coordinate pruning); else only
vectors that are long enough stay (length pruning). What stays is verified with
exact integer products.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.scratch import store
from contrail.llm.vectors import BLOCK, meet, usable

SCALE = 1024
STEP = 16  # groups for each doubling of the length
STEEP = 0.55  # cosine from which coordinates prune better than lengths
FOCUS = 4  # coordinates that are looked at
ROOM = 1e-9  # for rounding in the bounds


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products, (queries, vectors)."""
    top = int(np.abs(q).max(initial=0)) * int(np.abs(v).max(initial=0)) * q.shape[1]
    if top < 2**53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    if top < 2**63:
        return np.stack([(v * row).sum(axis=1) for row in q])
    raise OverflowError("inner products above 2**63 have no long score")


def _answers(q_ids, q, least, v_ids, v, k: int) -> pd.DataFrame:
    """Up to ``k`` best of one block for each query, none below its bound."""
    norms = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((v_ids, -norms))
    v_ids, v, norms = v_ids[order], v[order], norms[order]
    q_norms = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    unit = v / np.maximum(norms, 1e-300)[:, None]
    parts: list[tuple] = []
    by_length: list[tuple[int, int]] = []

    def keep(i: int, who: np.ndarray, score: np.ndarray) -> None:
        good = (who >= 0) & (v_ids[who] != q_ids[i]) & (score >= least[i])
        who, score = who[good], score[good]
        top = np.lexsort((v_ids[who], -score))[:k]
        parts.append((np.full(len(top), q_ids[i]), v_ids[who[top]], score[top]))

    for i in range(len(q)):
        reach = q_norms[i] * norms[0]
        if least[i] <= 0 or reach == 0:
            if least[i] <= 0 or reach >= least[i]:
                by_length.append((i, len(v)))
            continue
        cosine = least[i] / reach
        if cosine > 1 + ROOM:
            continue
        if cosine < STEEP:
            # Long enough: |v| >= bound / |q|.
            by_length.append((i, int(np.searchsorted(-norms, -(least[i] / q_norms[i]) * (1 - ROOM), side="right"))))
            continue
        direction = q[i] / q_norms[i]
        near = np.ones(len(v), dtype=bool)
        for f in np.argsort(-np.abs(direction))[:FOCUS]:
            a = direction[f]
            # a*x + sqrt(1-a^2)*sqrt(1-x^2) >= cosine holds between these two.
            middle, half = a * cosine, np.sqrt(max(0.0, (1 - a * a) * (1 - min(1.0, cosine) ** 2)))
            low = -1.0 if -a >= cosine else middle - half
            high = 1.0 if a >= cosine else middle + half
            near &= (unit[:, f] >= low - ROOM) & (unit[:, f] <= high + ROOM)
        who = np.flatnonzero(near)
        if len(who):
            keep(i, who, _products(q[i : i + 1], v[who])[0])
    # Together for queries that look at vectors of similar lengths.
    by_length.sort(key=lambda x: x[1])
    for at in range(0, len(by_length), 128):
        some = by_length[at : at + 128]
        most = some[-1][1]
        if most:
            got = _products(q[[i for i, _ in some]], v[:most])
            for (i, n), row in zip(some, got, strict=True):
                who = np.flatnonzero(row[:n] >= least[i])
                keep(i, who, row[who])
    columns = zip(*parts, strict=True) if parts else [[np.zeros(0, np.int64)]] * 3
    return pd.DataFrame({c: np.concatenate(x) for c, x in zip(("query_id", "vec_id", "score"), columns, strict=True)})


def _search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    def answer(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        return _answers(
            q["id"].to_numpy(), np.stack(q["vec"]), q["least"].to_numpy().astype(np.int64),
            v["id"].to_numpy(), np.stack(v["vec"]), k,
        )

    return meet(index, queries, answer, "query_id long, vec_id long, score long")


def top_products(
    df: DataFrame, is_query: str, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer inner products of each query.

    Components are ``floor(1024 * x)``. ``is_query`` is an SQL condition on
    ``id``. Vectors that are null or hold null or non-finite parts, rows without
    an id, and vectors of another than the commonest dimension take no part;
    repeated ids count once. A query never finds itself; ties go to the smaller
    id; all are returned if there are fewer than ``k``. Other columns are
    ignored; an empty table gives no rows.
    """
    whole = F.transform("vec", lambda x: F.floor(x * SCALE).cast("long"))
    rows = usable(df, id_col, vector_col, nonzero=False).select("id", whole.alias("vec"))
    norm2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    cell = F.when(norm2 > 0, F.floor(F.log2(norm2) / 2 * STEP)).otherwise(-1).cast("int")
    rows = store(rows.withColumn("cell", cell).withColumn("norm2", norm2), "integers")
    queries = rows.filter(is_query).select("id", "vec", F.sqrt("norm2").alias("q_norm"))

    # A block of the longest vectors bounds every query from below. Its size is fixed.
    longest = rows.orderBy(F.desc("norm2"), "id").limit(BLOCK).select("id", "vec", F.lit(0).alias("cell"))
    lowest = F.lit(-(2**62)).cast("long")
    first = _search(
        store(longest, "longest"), queries.select("id", "vec", F.lit(0).alias("cell"), lowest.alias("least")), k
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bounds = (
        first.withColumn("r", F.row_number().over(order)).filter(F.col("r") == k)
        .select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    )
    queries = store(queries.join(bounds, "id", "left").withColumn("least", F.coalesce("least", lowest)), "bounded")

    # A query goes only to the groups whose longest vector can reach its bound; groups are few.
    groups = rows.groupBy("cell").agg(F.sqrt(F.max("norm2")).alias("longest"))
    listed = groups.agg(F.collect_list(F.struct("cell", "longest")).alias("g"))
    reach = queries.select("*", F.explode(listed.scalar()).alias("g")).filter(
        F.col("q_norm") * F.col("g.longest") * (1 + ROOM) >= F.col("least")
    )
    asked = reach.select(F.col("g.cell").alias("cell"), "id", "vec", "least")
    found = _search(rows.select("cell", "id", "vec"), asked, k)
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
