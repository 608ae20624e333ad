"""Listing, compaction and verification of shards written from the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomvec.operators import compaction, verify
from loomvec.plans.catalog.registry import query, rendered, rendered_sql, table
from loomvec.session import file_system, materialise, scratch_path
from loomvec.sources import shards

_ROWS_PER_FILE = 10_000


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), "embedding", "label"
    )


def _write(rows, path):
    rows.write.option("maxRecordsPerFile", _ROWS_PER_FILE).partitionBy("label").parquet(path)


def _shard_dirs(spark, sf_dir):
    """Many small shards: one folder per label, whose id column is called id or _id."""
    path, rows = scratch_path(spark, "shards"), _vectors(spark, sf_dir)
    _write(rows.where("label < 5"), f"{path}/a")
    _write(rows.where("label >= 5").withColumnRenamed("id", "_id"), f"{path}/b")
    return [f"{path}/a/label=*", f"{path}/b/label=*"]


def _label(column):
    return F.regexp_extract(column, r"label=(\d+)", 1).cast("int").alias("label")


_ALL_SQL = f"SELECT CAST(vec_id AS VARCHAR) AS id, {rendered_sql('embedding')} AS vector FROM embeddings"


def _shown(rows):
    return rows.select("id", rendered(F.col("embedding")).alias("vector"))


@query(_ALL_SQL)
def read_shards(spark, sf_dir):
    return _shown(shards.read_shards(spark, *_shard_dirs(spark, sf_dir)))


@query("SELECT label, CAST(ceil(count(*) / 16) AS BIGINT) AS files FROM embeddings GROUP BY label")
def files_per_dir(spark, sf_dir):
    """Sixteen rows a file, each label written by one task."""
    path = scratch_path(spark, "files")
    rows = _vectors(spark, sf_dir).repartition("label")
    rows.write.option("maxRecordsPerFile", 16).partitionBy("label").parquet(path)
    return shards.files_per_dir(shards.list_shards(spark, f"{path}/label=*")).select(_label("dir"), "files")


def _good_and_bad(spark, sf_dir):
    """One folder of shards and three of files that are none: other types, more columns, no Parquet."""
    path, rows = scratch_path(spark, "kinds"), _vectors(spark, sf_dir)
    plain = rows.select("id", "embedding")
    plain.write.parquet(f"{path}/plain")
    plain.withColumn("embedding", F.col("embedding").cast("array<double>")).write.parquet(f"{path}/doubles")
    rows.write.parquet(f"{path}/extra")
    rows.select("id").coalesce(1).write.text(f"{path}/text")
    files, folder = file_system(spark, f"{path}/text")
    for file in files.listStatus(folder):
        if file.getPath().getName().startswith("part-"):
            files.rename(file.getPath(), file.getPath().suffix(".parquet"))
    return f"{path}/*"


@query(_ALL_SQL)
def read_shards_skip_bad(spark, sf_dir):
    return _shown(shards.read_shards(spark, _good_and_bad(spark, sf_dir), skip_bad=True))


@query(f"SELECT unnest(['doubles', 'extra', 'text']) AS kind, unnest(['{shards.NOT_A_SHARD}', '{shards.NOT_A_SHARD}', 'unreadable']) AS error")
def rejects_report(spark, sf_dir):
    found = shards.rejected_shards(spark, _good_and_bad(spark, sf_dir))
    kind = F.regexp_extract("path", r"/([a-z]+)/[^/]*$", 1).alias("kind")
    return found.select(kind, F.when(F.col("columns").isNull(), "unreadable").otherwise(F.col("error")).alias("error")).distinct()


@query("""
    SELECT label, true AS readable, count(*) AS rows,
           CASE WHEN label < 5 THEN 'id' ELSE '_id' END || ': string, embedding: list<element: float>' AS columns
    FROM embeddings GROUP BY label""")
def file_report(spark, sf_dir):
    report = verify.file_report(spark, *_shard_dirs(spark, sf_dir))
    return report.groupBy(_label("dir"), "readable", "columns").agg(F.sum("rows").alias("rows"))


@query("SELECT label, count(*) AS rows FROM embeddings GROUP BY label")
def rows_per_file(spark, sf_dir):
    read = spark.read.schema(shards.SHARD_SCHEMA).parquet(*_shard_dirs(spark, sf_dir))
    return verify.rows_per_file(read).groupBy(_label("file_path")).agg(F.sum("rows").alias("rows"))


@query("SELECT label, count(*) AS rows, true AS chunks_hold, true AS in_path_order FROM embeddings GROUP BY label")
def plan_compaction(spark, sf_dir):
    """Rows planned per label; no chunk above 4 files, and chunks follow the path order."""
    files = shards.inspect_shards(shards.list_shards(spark, *_shard_dirs(spark, sf_dir)))
    plan = compaction.plan_compaction(files, files_per_chunk=4)
    chunks = plan.groupBy("chunk").agg(
        F.count("*").alias("files"), F.min("path").alias("first"), F.max("path").alias("last")
    )
    other = chunks.select((F.col("chunk") - 1).alias("chunk"), F.col("first").alias("next_first"))
    checked = chunks.join(other, "chunk", "left").select(
        "chunk",
        (F.col("files") <= 4).alias("holds"),
        (F.coalesce("next_first", F.lit("~")) > F.col("last")).alias("ordered"),
    )
    return (
        plan.join(checked, "chunk")
        .groupBy(_label("dir"))
        .agg(
            F.sum("rows").alias("rows"),
            F.bool_and("holds").alias("chunks_hold"),
            F.bool_and("ordered").alias("in_path_order"),
        )
    )


@query("""
    SELECT CAST(sum(files) AS BIGINT) AS files, true AS within, true AS in_path_order, true AS fewer_than_by_count FROM (
      SELECT ceil(count(*) / 16) AS files FROM embeddings GROUP BY label)""")
def plan_by_bytes(spark, sf_dir):
    """Chunks of eight average files by bytes, beside chunks of four files."""
    path = scratch_path(spark, "files")
    rows = _vectors(spark, sf_dir).repartition("label")
    rows.write.option("maxRecordsPerFile", 16).partitionBy("label").parquet(path)
    files = materialise(shards.list_shards(spark, f"{path}/label=*"), "listing")
    sizes = files.agg(F.avg("length").alias("average"), F.max("length").alias("largest")).first()
    target = int(8 * sizes.average)
    chunks = compaction.plan_compaction(files, chunk_bytes=target).groupBy("chunk").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.min("path").alias("first"), F.max("path").alias("last")
    )
    by_count = compaction.plan_compaction(files, files_per_chunk=4).agg(F.max("chunk") + 1).scalar()
    after = chunks.select((F.col("chunk") - 1).alias("chunk"), F.col("first").alias("next_first"))
    checked = chunks.join(after, "chunk", "left")
    return checked.agg(
        F.sum("files").alias("files"),
        F.bool_and(F.col("bytes") <= target + sizes.largest).alias("within"),
        F.bool_and(F.coalesce("next_first", F.lit("~")) > F.col("last")).alias("in_path_order"),
        ((F.max("chunk") == F.count("*") - 1) & (F.count("*") < F.max(by_count))).alias("fewer_than_by_count"),
    )


@query(_ALL_SQL)
def consolidate_by_bytes(spark, sf_dir):
    output = scratch_path(spark, "consolidated")
    compaction.compact(spark, _shard_dirs(spark, sf_dir), output, layout="chunks", chunk_bytes=50_000)
    return _shown(compaction.read_consolidated(spark, output))


@query(_ALL_SQL)
def consolidate(spark, sf_dir):
    output = scratch_path(spark, "consolidated")
    compaction.compact(spark, _shard_dirs(spark, sf_dir), output)
    return _shown(compaction.read_consolidated(spark, output))


@query(_ALL_SQL)
def consolidate_in_chunks(spark, sf_dir):
    output = scratch_path(spark, "consolidated")
    dirs = _shard_dirs(spark, sf_dir)
    compaction.compact(spark, dirs, output, layout="chunks")
    return _shown(compaction.read_consolidated(spark, output))


@query("""
    SELECT CAST(sum(files) AS BIGINT) AS files_in, true AS fewer_out FROM (
      SELECT ceil(count(*) / 16) AS files FROM embeddings GROUP BY label)""")
def consolidated_files(spark, sf_dir):
    """Files before compaction, and whether there are fewer after it."""
    path, output = scratch_path(spark, "files"), scratch_path(spark, "consolidated")
    rows = _vectors(spark, sf_dir).repartition("label")
    rows.write.option("maxRecordsPerFile", 16).partitionBy("label").parquet(path)
    done = compaction.compact(spark, [f"{path}/label=*"], output)
    after = shards.list_shards(spark, f"{output}/wave=*").agg(F.count("*").alias("n"))
    return after.select(F.lit(done.files).cast("bigint").alias("files_in"), (F.col("n") < done.files).alias("fewer_out"))


@query("""
    SELECT count(*) FILTER (label < 5) AS rows_first, count(*) FILTER (label >= 5) AS rows_second,
           0 AS files_third, count(*) AS rows_in_output FROM embeddings""")
def consolidate_again(spark, sf_dir):
    """Compact one half of the folders, then all of them, then all of them again."""
    output, dirs = scratch_path(spark, "consolidated"), _shard_dirs(spark, sf_dir)
    first = compaction.compact(spark, dirs[:1], output)
    second = compaction.compact(spark, dirs, output)
    third = compaction.compact(spark, dirs, output)
    return compaction.read_consolidated(spark, output).agg(
        F.lit(first.rows_written).cast("bigint").alias("rows_first"),
        F.lit(second.rows_written).cast("bigint").alias("rows_second"),
        F.lit(third.files).alias("files_third"),
        F.count("*").alias("rows_in_output"),
    )


@query("""
    SELECT 'plain' AS kind, true AS conforms, count(*) AS rows FROM embeddings
    UNION ALL SELECT 'doubles', false, count(*) FROM embeddings
    UNION ALL SELECT 'extra', false, count(*) FROM embeddings""")
def schema_conformity(spark, sf_dir):
    path, rows = scratch_path(spark, "kinds"), _vectors(spark, sf_dir)
    plain = rows.select("id", "embedding")
    plain.write.parquet(f"{path}/plain")
    plain.withColumn("embedding", F.col("embedding").cast("array<double>")).write.parquet(f"{path}/doubles")
    rows.write.parquet(f"{path}/extra")
    found = shards.inspect_shards(shards.list_shards(spark, f"{path}/*"))
    kind = F.element_at(F.split("dir", "/"), -1).alias("kind")
    return found.groupBy(kind, "conforms").agg(F.sum("rows").alias("rows"))


@query("""
    SELECT count(*) AS source_rows, count(*) AS output_rows, true AS same_ids, true AS same_rows FROM embeddings""")
def reconcile(spark, sf_dir):
    output, dirs = scratch_path(spark, "consolidated"), _shard_dirs(spark, sf_dir)
    compaction.compact(spark, dirs, output)
    return verify.reconcile(shards.read_shards(spark, *dirs), compaction.read_consolidated(spark, output))


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS id, 1 AS in_source, 0 AS in_output FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def count_differences(spark, sf_dir):
    docs, labelled = (
        table(spark, sf_dir, name).select(F.col("doc_id").cast("string").alias("id"))
        for name in ("documents", "labels")
    )
    found = verify.count_differences(docs, labelled)
    return found.select("id", F.col("in_source").cast("int"), F.col("in_output").cast("int"))
