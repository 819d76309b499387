"""The named queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import language_id, toxicity
from contrail.llm.ann import nearest
from contrail.llm.bpe import encode_texts
from contrail.llm.exact_topk import top_products
from contrail.llm.html_text import main_text
from contrail.llm.infill import assemble, fim_pieces
from contrail.llm.mixing import mix_sources
from contrail.llm.ngram_join import similar_groups
from contrail.llm.packing import pack_documents
from contrail.llm.scratch import ship_code
from contrail.llm.sharding import shard_rows, write_shards
from contrail.llm.token_counts import count_edited
from contrail.llm.vector_codes import compress
from contrail.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from two thirds of the labelled ones."""
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~_held_out()))
    named = language_id.identify(docs.select("doc_id", "text"), model).drop("text")
    return named.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text before and after personal data is masked."""
    return count_edited(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that link at 0.9 on three-word shingles."""
    return similar_groups(_table(spark, sf_dir, "documents"), words=3, p=90, q=100)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth one."""
    return nearest(_table(spark, sf_dir, "embeddings"), "id % 20 = 0", k=20)


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest integer products of every hundredth vector."""
    return top_products(_table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(_table(spark, sf_dir, "pages"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every document is taken so that sources meet their target weights."""
    mixed = mix_sources(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, cap=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, written as 40 shuffled shards; the key decides the shard. Returns a digest of the written rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = (F.octet_length(text) + 16).cast("long")
    number = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    docs = _table(spark, sf_dir, "documents").select("*", *[c.alias(n) for n, c in number.items()]).withColumn("size", size)
    shards = write_shards(shard_rows(docs, 40, number=[*number]), scratch_path(spark, "shards"))
    return shards.select(
        "doc_id", size.alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", "grown_shard",
    )


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    packed = pack_documents(_table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from two thirds of the labelled ones."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~_held_out()))
    scored = toxicity.score(docs.select("doc_id", "text"), model).drop("text")
    return scored.select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", "predicted",
        "sentence_start", "sentence_end", "sentence_score", "sentences_flagged",
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its middle moved, and the text rebuilt from that, as digests."""
    number = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", *[c.alias(n) for n, c in number.items()])
    return assemble(fim_pieces(docs, number=[*number], seed=42, rate=50, spm_rate=80))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors under four codebooks of 256 entries after four rounds."""
    return compress(_table(spark, sf_dir, "embeddings"), entries=256, rounds=4, parts=4).drop("label")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again, as digests."""
    both = encode_texts(_table(spark, sf_dir, "documents"), decoded="decoded")
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_nearest": op4_nearest,
    "op5_exact_topk": op5_exact_topk,
    "op6_main_text": op6_main_text,
    "op7_mix_sources": op7_mix_sources,
    "op8_shard": op8_shard,
    "op9_pack": op9_pack,
    "op10_toxicity": op10_toxicity,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_vector_codes": op12_vector_codes,
    "op13_bpe": op13_bpe,
}

OP5_SQL = """
WITH v AS (
    SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
p AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.e, c.e)]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP11_SQL = r"""
WITH d AS (
    SELECT doc_id, COALESCE(text, '') AS t, sha256('42:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(COALESCE(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents
),
f AS (
    SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                  OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM d
),
p AS (
    SELECT *, array_to_string(u[1:least(a, b)], '') AS x, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS y,
           array_to_string(u[greatest(a, b) + 1:], '') AS z
    FROM f
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(x) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(y) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
              ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

_OP12_ROUND = """
a{i} AS MATERIALIZED (
    SELECT v.vec_id, v.part, v.p, arg_min(c.entry, (d, c.entry)) AS entry, min(d) AS d
    FROM (SELECT v.vec_id, v.part, v.p, c.entry,
                 CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v.p, c.p)]) AS BIGINT) AS d
          FROM v JOIN c{i} c USING (part)) c JOIN v USING (vec_id, part)
    GROUP BY ALL
)"""

_OP12_MOVE = """
c{j} AS MATERIALIZED (
    SELECT c.part, c.entry, COALESCE(m.p, c.p) AS p
    FROM c{i} c LEFT JOIN (
        SELECT part, entry, list(x ORDER BY j) AS p FROM (
            SELECT part, entry, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
                SELECT part, entry, j, CAST(sum(p[j]) AS BIGINT) AS s, count(*) AS n
                FROM a{i}, LATERAL (SELECT unnest(range(1, len(p) + 1)) AS j) GROUP BY ALL)) GROUP BY ALL) m
    USING (part, entry)
)"""

OP12_SQL = (
    """
WITH k AS MATERIALIZED (
    SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
v AS MATERIALIZED (SELECT vec_id, part, e[part * len(e) // 4 + 1 : (part + 1) * len(e) // 4] AS p FROM k, (SELECT unnest(range(4)) AS part)),
c0 AS MATERIALIZED (
    SELECT part, rank() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p
    FROM v WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 256)
),"""
    + ",".join(_OP12_ROUND.format(i=i) + "," + _OP12_MOVE.format(i=i, j=i + 1) for i in range(4))
    + ","
    + _OP12_ROUND.format(i=4)
    + """,
f AS (SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY 1),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM f JOIN k USING (vec_id) GROUP BY 1)
SELECT f.vec_id, f.code, f.error, l.label_error,
       (SELECT sha256(string_agg(CAST(p[j] AS VARCHAR), ',' ORDER BY part, entry, j))
        FROM c4, LATERAL (SELECT unnest(range(1, len(p) + 1)) AS j)) AS codebooks_sha256
FROM f JOIN k USING (vec_id) JOIN l ON l.label IS NOT DISTINCT FROM k.label
"""
)

ORACLE_SQL: dict[str, str] = {"op5_exact_topk": OP5_SQL, "op11_fill_in_middle": OP11_SQL, "op12_vector_codes": OP12_SQL}
