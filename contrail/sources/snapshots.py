"""Snapshot documents: read, audit, and flatten to raw observations.

A document is one poll of one region in either envelope, ``{now, total, ac[]}``
or ``{region, region_label, ingested_at, api_url, aircraft_count, aircraft[]}``.
The schema is explicit, so no inference pass runs and an empty array is harmless.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from contrail import schemas
from contrail.functions import columns as C
from contrail.functions.time import from_epoch_millis, instant, iso_text
from contrail.sources.regions import with_region
from contrail.sources.tables import Lake

_PARENT_FOLDER = r"([^/=]+)/[^/]+$"  # "delhi/x.json" and "region=delhi/x.json" alike
_FILE_NAME = r"([^/]+)$"


def _folder(path: str, level: int) -> Column:
    """The name of the folder ``level`` steps above a file; "region=delhi" is delhi."""
    if level == 1:
        return F.regexp_extract(path, _PARENT_FOLDER, 1)
    name = F.coalesce(F.try_element_at(F.split(path, "/"), F.lit(-1 - level)), F.lit(""))
    return F.regexp_replace(name, "^[^=]*=", "")


def read_documents(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, pattern: str = "*.json", region_level: int = 1
) -> DataFrame:
    """One row per document, with its file and folder.

    The folder names the region of documents that do not; ``region_level`` says
    how many steps above the file it lies, 2 for "delhi/2026-06-08/0700.json".

    ``multi_line`` suits one pretty-printed document per file; turn it off for
    line-delimited landings, whose files Spark can split.
    """
    return _documents(_json(spark.read, multi_line, pattern).load(path), region_level)


def stream_documents(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    max_files: int | None = None,
    pattern: str = "*.json",
    region_level: int = 1,
) -> DataFrame:
    """The same rows as a file-source stream; its checkpoint remembers seen files."""
    reader = _json(spark.readStream, multi_line, pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _documents(reader.load(path), region_level)


def _json(reader, multi_line: bool, pattern: str):
    return (
        reader.option("recursiveFileLookup", True)
        .format("json")
        .schema(schemas.DOCUMENT)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("pathGlobFilter", pattern)
    )


def _documents(df: DataFrame, region_level: int) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_name").alias("_file_name"),
        _folder("_metadata.file_path", region_level).alias("_folder"),
    )


def documents_from_text(df: DataFrame, text: str, source_file: Column) -> DataFrame:
    """Documents from a text column, e.g. the raw landing table."""
    parsed = F.from_json(
        F.col(text), schemas.DOCUMENT, {"columnNameOfCorruptRecord": "_corrupt_record"}
    )
    return df.select(parsed.alias("d"), source_file.alias("_source_file")).select(
        "d.*",
        "_source_file",
        F.regexp_extract("_source_file", _FILE_NAME, 1).alias("_file_name"),
        F.regexp_extract("_source_file", _PARENT_FOLDER, 1).alias("_folder"),
    )


def land_raw(
    spark: SparkSession, path: str, as_of: datetime | None = None, per_line: bool = False
) -> DataFrame:
    """Whole documents as text with their ingestion time."""
    return spark.read.text(path, wholetext=not per_line, recursiveFileLookup=True).select(
        F.col("value").alias("raw_json"), instant(as_of).alias("ingestion_time")
    )


def _elements(docs: DataFrame) -> DataFrame:
    """One row per element; documents without elements vanish here."""
    return docs.select(
        "*", F.posexplode(F.coalesce("ac", "aircraft")).alias("_position", "_payload")
    ).withColumn("e", F.from_json("_payload", schemas.ELEMENT))


def flatten_snapshots(
    docs: DataFrame, as_of: datetime | None = None, ids: str = "hash"
) -> DataFrame:
    """Documents to raw observations of profile N.

    ``ids="hash"`` derives the id from file, poll time, the whole document,
    position and key, and numbers documents of one file that are equal in all of
    it: stable across runs and unique per raw row, but the same if a file is
    landed twice. ``ids="uuid"`` draws random ids, which change when read again.
    """
    hex_id = F.col("e.hex")
    if ids == "uuid":
        row_id = F.expr("uuid()")
    else:
        row_id = F.md5(F.concat_ws("|", "_source_file", "_digest", "_copy", F.col("_position"), hex_id))
        content = F.to_json(F.struct("now", "ingested_at", F.coalesce("ac", "aircraft").alias("ac")))
        docs = docs.withColumn("_digest", F.md5(F.coalesce(content, F.lit(""))))
        same = Window.partitionBy("_source_file", "_digest").orderBy(F.lit(0))
        # A stream cannot number rows; equal documents of one file share ids there.
        docs = docs.withColumn("_copy", F.lit(1) if docs.isStreaming else F.row_number().over(same))
    polled = F.coalesce(
        from_epoch_millis(F.col("now")),
        F.date_trunc("second", F.try_to_timestamp("ingested_at")),
        instant(as_of),
    )
    altitude = F.col("e.alt_baro")
    picked = {
        "ingestion_id": row_id,
        "fetched_at": polled,
        "source_region": F.coalesce("region", C.empty_to_null(F.col("_folder"))),
        "api_endpoint": F.col("api_url"),
        "hex": hex_id,
        "flight": F.trim("e.flight"),
        "alt_baro": C.whole_number_or_null(altitude),
        "alt_geom": C.lenient_int(F.col("e.alt_geom")),
        "baro_rate": C.lenient_int(F.col("e.baro_rate")),
        "registration": F.col("e.r"),
        "aircraft_type": F.col("e.t"),
        "ownop": F.col("e.ownOp"),
        "db_flags": C.lenient_int(F.col("e.dbFlags")),
        "raw_payload": F.col("_payload"),
        "_ingested_at": instant(as_of),
        "_source_file": F.col("_source_file"),
    }
    return _project(
        _elements(docs).filter(C.empty_to_null(hex_id).isNotNull()), schemas.RAW_N, picked
    )


def flatten_enriched(docs: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Documents to the wider raw observations of profile L; empty text is NULL."""
    picked = {
        "flight": C.tidy(F.col("e.flight")),
        "registration": C.empty_to_null(F.col("e.r")),
        "aircraft_type": C.empty_to_null(F.col("e.t")),
        "messages": C.empty_to_null(F.col("e.messages")).try_cast("bigint"),
        "_region": F.coalesce("e._region", "region"),
        "_region_label": F.coalesce("e._region_label", "region_label"),
        "_ingested_at": F.try_to_timestamp(F.coalesce("e._ingested_at", "ingested_at")),
        "_source_url": F.coalesce("e._source_url", "api_url"),
        "_loaded_at": instant(as_of),
        "_source_file": F.col("_file_name"),
        "_raw_json": F.col("_payload"),
    }
    return _project(_elements(docs), schemas.RAW_L, picked, blank_is_null=True)


def _project(df: DataFrame, schema, picked: dict[str, Column], blank_is_null=False) -> DataFrame:
    """Schema order; a column without its own rule is the element field cast to its type."""
    casts = {"double": C.lenient_double, "int": C.lenient_int}
    out = []
    for field in schema.fields:
        value = picked.get(field.name)
        if value is None:
            value = F.col(f"e.{field.name}")
            if blank_is_null:
                value = C.empty_to_null(value)
            value = casts.get(field.dataType.simpleString(), lambda c: c)(value)
        out.append(value.alias(field.name))
    return df.select(*out)


def enrich_documents(
    docs: DataFrame, base_url: str, roster: str = "world", as_of: datetime | None = None
) -> DataFrame:
    """API envelope to enriched envelope: poll metadata on the document and each element."""
    url = F.concat(
        F.lit(base_url.rstrip("/")),
        F.lit("/lat/"), F.col("centre_lat"),
        F.lit("/lon/"), F.col("centre_lon"),
        F.lit("/dist/"), F.col("radius_nm"),
    )
    keyed = docs.withColumn("_region_key", F.coalesce("region", "_folder"))
    stamped = (
        with_region(keyed, "_region_key", roster)
        .withColumn("_url", F.coalesce("api_url", url))
        .withColumn("_polled", iso_text(as_of))
    )
    meta = F.to_json(
        F.struct(
            F.col("_region_key").alias("_region"),
            F.col("label").alias("_region_label"),
            F.col("_polled").alias("_ingested_at"),
            F.col("_url").alias("_source_url"),
        )
    )

    def stamp(element: Column) -> Column:
        body = F.trim(element)
        return F.when(body == "{}", F.col("_meta")).otherwise(
            F.concat(
                body.substr(F.lit(1), F.length(body) - 1),
                F.lit(","),
                F.col("_meta").substr(F.lit(2), F.length("_meta")),
            )
        )

    elements = F.coalesce("ac", "aircraft", F.array().cast("array<string>"))
    return stamped.withColumn("_meta", meta).select(
        F.col("_region_key").alias("region"),
        F.col("label").alias("region_label"),
        F.col("_polled").alias("ingested_at"),
        F.col("_url").alias("api_url"),
        F.size(elements).cast("bigint").alias("aircraft_count"),
        F.transform(elements, stamp).alias("aircraft"),
        "_source_file",
    )


def audit_files(docs: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One audit row per file: rows loaded, and whether the file could be read.

    Nothing is loaded from a file with a malformed document, so it counts 0 rows.
    """
    bad = F.col("_corrupt_record").isNotNull()
    loaded = F.sum(F.when(~bad, F.greatest(F.size(F.coalesce("ac", "aircraft")), F.lit(0))))
    broken = F.count_if(bad) > 0
    return docs.groupBy(
        F.col("_file_name").alias("file_name"), F.col("_folder").alias("region"),
        F.col("_source_file").alias("file_path"),
    ).agg(
        instant(as_of).alias("ingested_at"),
        F.when(broken, 0).otherwise(F.coalesce(loaded, F.lit(0))).cast("int").alias("records_loaded"),
        instant(as_of).alias("loaded_at"),
        F.when(broken, "ERROR").otherwise("OK").alias("status"),
        F.when(broken, "malformed JSON document").alias("error_msg"),
    ).select(*schemas.AUDIT.names)


def new_files(
    spark: SparkSession, path: str, audit: DataFrame, pattern: str = "*.json", region_level: int = 1
) -> DataFrame:
    """(path, file_name, region) of files that no audit row reports as loaded.

    A file is known by its whole path, since feeds may use one name in many
    folders; audit rows without a path, from before it was kept, by name and
    folder. Only the listing is read, never the content. Files that failed or
    were empty are offered again.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"))
        .select(
            "path",
            F.regexp_extract("path", _FILE_NAME, 1).alias("file_name"),
            _folder("path", region_level).alias("region"),
        )
    )
    loaded = audit.filter("status = 'OK' AND records_loaded > 0")
    paths = loaded.filter("file_path IS NOT NULL").select(F.col("file_path").alias("path"))
    names = loaded.filter("file_path IS NULL").select("file_name", "region")
    return listed.join(paths, "path", "left_anti").join(names, ["file_name", "region"], "left_anti")


def _readable(docs: DataFrame) -> DataFrame:
    """Documents of files without a malformed one; nothing is loaded from the others."""
    # Spark refuses to read the mark of malformed documents alone, so a count goes along.
    failed = (
        docs.groupBy("_source_file")
        .agg(F.count_if(F.col("_corrupt_record").isNotNull()).alias("bad"), F.count("aircraft").alias("read"))
        .filter("bad > 0 AND read >= 0").select("_source_file")
    )
    return docs.join(failed, "_source_file", "left_anti")


def ingest_new(
    spark: SparkSession,
    path: str,
    audit: DataFrame,
    as_of: datetime | None = None,
    profile: str = "L",
    multi_line: bool = True,
    region_level: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """(raw rows, audit rows) of the files not loaded yet.

    For runs by hand, and to try failed files again: the new paths go through the
    driver, as in any file listing Spark does. Feeds use :func:`ingest_stream`,
    which tracks files itself.
    """
    found = new_files(spark, path, audit, region_level=region_level)
    paths = [row.path for row in found.select("path").toLocalIterator()]
    if not paths:
        raw = schemas.RAW_L if profile == "L" else schemas.RAW_N
        return spark.createDataFrame([], raw), spark.createDataFrame([], schemas.AUDIT)
    docs = read_documents(spark, sorted(paths), multi_line, region_level=region_level)
    flatten = flatten_enriched if profile == "L" else flatten_snapshots
    return flatten(_readable(docs), as_of), audit_files(docs, as_of)


def ingest_stream(
    spark: SparkSession,
    path: str,
    lake: Lake,
    checkpoint: str,
    profile: str = "L",
    multi_line: bool = True,
    pattern: str = "*.json",
    region_level: int = 1,
    max_files: int | None = None,
    every: str | None = None,
    clock: Callable[[], datetime] | None = None,
) -> StreamingQuery:
    """Load and audit the files that arrived since the last run, or at every interval.

    The file source keeps the list of files by whole path in the checkpoint; no
    list passes through the driver's Python. Each micro-batch writes the raw rows
    of its readable files and one audit row per file, below its epoch, and then
    commits; an epoch delivered again replaces its own folders. Files that failed
    are in the audit as ERROR and can be tried again with :func:`ingest_new`.
    """
    table = "raw_l" if profile == "L" else "raw"
    flatten = flatten_enriched if profile == "L" else flatten_snapshots

    def step(batch: DataFrame, epoch: int) -> None:
        now = clock() if clock else datetime.now(timezone.utc)
        docs = batch.persist()  # read once; partitions lost with an executor are read again
        try:
            lake.write_log("audit", audit_files(docs, now), epoch)
            lake.write_log(table, flatten(_readable(docs), now), epoch)
        finally:
            docs.unpersist()
        audit = lake.read_batch("audit", schemas.AUDIT, epoch)
        counts = audit.agg(F.count(F.lit(1)).alias("files"), F.sum("records_loaded").alias("rows"))
        lake.commit(epoch, "INGEST", counts, now, f"{checkpoint}#{epoch}")

    docs = stream_documents(spark, path, multi_line, max_files, pattern, region_level)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return docs.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger).start()
