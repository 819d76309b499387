"""The corpus pipeline: what is toxic or has no language goes, one of each near-duplicate
group stays, sources are mixed to their target weights, and the rest is packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm import language_id, toxicity
from contrail.llm.mixing import mix_sources
from contrail.llm.ngram_join import similar_groups
from contrail.llm.packing import pack_documents
from contrail.llm.scratch import ship_code, store

BROADCAST_IDS = 1_000_000  # most row numbers or file names sent to all executors


def _trains() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1


def _bounded(ids: DataFrame) -> DataFrame:
    """``ids``, with a broadcast hint when they are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _hidden(docs: DataFrame, shown: tuple[str, ...] = ()) -> dict[str, str]:
    """A reserved name for every column but the ``shown`` ones, so that no name of ours meets one of the table."""
    return {c: c if c in shown else f"_kept_{i}" for i, c in enumerate(docs.columns)}


def _numbered(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """The rows of a written table under ``names``, with ``_rid``, which tells them apart whatever they hold.

    It is made of the file's number and the row's place in the file. A frame that
    is no table is written first.
    """
    columns = [F.col(c).alias(n) for c, n in names.items()]
    try:
        rows = docs.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return _numbered(store(docs, "table"), names)
    # One row a file, sorted in one task; a table has far fewer files than rows.
    files = rows.select("_file").distinct().withColumn("_no", F.row_number().over(Window.orderBy("_file")))
    numbered = rows.join(_bounded(store(files, "files")), "_file")
    return numbered.withColumn("_rid", F.shiftleft(F.col("_no").cast("long"), 40) + F.col("_row")).drop("_file", "_no", "_row")


def _shown(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """The table's columns under their own names again."""
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])


def _shielded(docs: DataFrame, apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``apply`` on the table with all columns but id and text hidden, so that a column named like one that an operator makes stays."""
    names = _hidden(docs, ("doc_id", "text"))
    return _shown(apply(docs.select(*[F.col(c).alias(n) for c, n in names.items()])), names)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below the threshold; null, empty and blank texts stay.

    Every row is judged by its own text, so repeated rows share their fate. An
    empty table, and one without labels, stays as it is.
    """
    ship_code(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.filter(_trains()))
    return _shielded(docs, lambda rows: toxicity.score(rows, model).filter("predicted = 0"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; ``lang`` stays as it was.

    Null texts and texts without a letter have none. Where no row has both text
    and label, nothing is learned and no row stays.
    """
    ship_code(spark)
    model = language_id.fit(docs.filter(_trains()))
    return _shielded(
        docs, lambda rows: language_id.identify(rows, model).filter(F.col("lang_pred") != language_id.UNKNOWN)
    )


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group that links at 0.8 on five words: that of the smallest id.

    Rows count by themselves: rows of one id with other texts are other
    documents, equal rows are a group, and rows without an id take part (a null
    id is the largest; ties go by the row's content). Texts without words link
    with nothing and stay.
    """
    ship_code(spark)
    names = _hidden(docs)
    rows = _numbered(docs, names)
    groups = similar_groups(rows.select(F.col("_rid").alias("doc_id"), F.col(names["text"]).alias("text")), words=5, p=80, q=100)
    groups = store(groups.select(F.col("doc_id").alias("_rid"), "component_id"), "groups")
    shared = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("component_id")
    members = groups.join(shared, "component_id")
    doc_id = F.col(names["doc_id"])
    place = F.struct(doc_id.isNull(), doc_id, F.xxhash64(*names.values()), "_rid")
    named = rows.select("_rid", place.alias("_place"))
    first = members.join(named, "_rid").groupBy("component_id").agg(F.min_by("_rid", "_place").alias("_rid"))
    gone = store(members.select("_rid").join(first.select("_rid"), "_rid", "left_anti"), "gone")
    return _shown(rows.join(_bounded(gone), "_rid", "left_anti"), names)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it; texts without words are never taken.

    A row's turn in the mix goes by its id and content, so that reruns agree
    whatever files the table lies in. Equal rows are drawn one by one and come
    out as often as all of them together are taken.
    """
    ship_code(spark)
    names = _hidden(docs)
    rows = _numbered(docs, names)
    key = F.struct(F.col(names["doc_id"]).alias("doc_id"), F.xxhash64(*names.values()).alias("content"))
    sized = rows.select(key.alias("doc_id"), *[F.col(names[c]).alias(c) for c in ("source", "text")])
    drawn = mix_sources(sized, weights=(3, 1, 2), share=1.5, cap=2.0)
    taken = drawn.groupBy(F.col("doc_id").alias("_key")).agg(F.sum("copies").alias("_copies")).filter("_copies > 0")
    places = rows.select(key.alias("_key"), "_rid").groupBy("_key").agg(F.min("_rid").alias("_rid"))
    same = places["_key"].eqNullSafe(taken["_key"])
    wanted = store(places.join(taken, same).select("_rid", "_copies"), "copies")
    out = rows.join(_bounded(wanted), "_rid")
    return _shown(out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))), names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 2048 ids; a null text is its end id alone."""
    ship_code(spark)
    packed = pack_documents(docs)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", remove_toxic),
    ("language", identify_language),
    ("near duplicates", join_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: The stages learn models, so that SQL cannot express them; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = store(docs, "stage")
    return docs
