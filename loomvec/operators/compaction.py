"""Compaction of many small shards into few large files, resumable through a manifest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomvec.operators.batching import assign_chunks
from loomvec.operators.ordering import with_positions, with_running_sum
from loomvec.operators.resume import skip_existing_chunks
from loomvec.session import materialise, session_conf
from loomvec.sources.shards import (
    DAMAGED,
    SHARD_SCHEMA,
    escape_glob,
    inspect_shards,
    list_shards,
    located,
    rows_decoded,
)

MANIFEST_SCHEMA = "path string, file_path string, length bigint, rows bigint, chunk bigint, wave bigint"


@dataclass(frozen=True)
class Compaction:
    """What one call of :func:`compact` did."""

    files: int
    chunks: int
    waves: int
    rows_expected: int
    rows_written: int
    rejects: DataFrame


def plan_compaction(
    files: DataFrame, files_per_chunk: int = 10_000, first_chunk: int = 0, chunk_bytes: int | None = None
) -> DataFrame:
    """Number the files by full path and cut the list every ``files_per_chunk``, or every ``chunk_bytes``.

    By bytes a file belongs to the stretch of ``chunk_bytes`` it begins in, so a chunk is at most one file larger; a
    file of several stretches leaves no empty chunks. Sums run over a range sort, whose partitions are summed apart.
    """
    if chunk_bytes is None:
        chunked = assign_chunks(files, ["path"], files_per_chunk)
        return chunked.withColumn("chunk", F.col("chunk") + first_chunk)
    summed = with_running_sum(files, [], ["path"], "length", "_upto")
    # Empty files belong to the stretch before them: they take nothing of a next one.
    begins = F.col("_upto") - F.col("length")
    stretch = F.greatest(F.floor((begins - (F.col("length") == 0).cast("int")) / chunk_bytes), F.lit(0))
    summed = materialise(summed.withColumn("_stretch", stretch).drop("_upto"), "stretches")
    numbered = with_positions(summed.select("_stretch").distinct(), [], ["_stretch"], "_at")
    placed = summed.join(materialise(numbered, "chunks"), "_stretch")
    return placed.withColumn("chunk", F.col("_at") - 1 + first_chunk).drop("_stretch", "_at")


def read_manifest(spark: SparkSession, output_dir: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{output_dir}/_manifest")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def read_consolidated(spark: SparkSession, output_dir: str) -> DataFrame:
    """``(id, embedding)`` of the finished waves; a wave cut off half-way is not read."""
    waves = [row.wave for row in read_manifest(spark, output_dir).select("wave").distinct().collect()]
    if not waves:
        return spark.createDataFrame([], "id string, embedding array<float>")
    paths = [_wave_dir(output_dir, wave) for wave in sorted(waves)]
    # Chunk folders sit one level down in the layout that has them.
    table = spark.read.option("recursiveFileLookup", "true").schema("id string, embedding array<float>")
    return table.parquet(*paths)


def _wave_dir(output_dir: str, wave: int) -> str:
    return f"{output_dir}/wave={wave:05d}"


def _write_packed(spark: SparkSession, rows: DataFrame, path: str, target_bytes: int) -> None:
    # The scan itself packs small files up to target_bytes per task, so each task
    # writes one file of about that size and no row is shuffled.
    with session_conf(
        spark,
        **{
            "files.maxPartitionBytes": str(target_bytes),
            "files.openCostInBytes": "0",
            "files.minPartitionNum": "1",
        },
    ):
        data = rows.select(F.coalesce("id", "_id").alias("id"), "embedding")
        data.write.mode("overwrite").option("compression", "zstd").parquet(path)


def _write_chunks(rows: DataFrame, plan: DataFrame, path: str, target_bytes: int) -> None:
    # One folder per chunk. A chunk above target_bytes is spread over several tasks
    # by row, so neither a large file nor a repeated id makes one task slow.
    chunk_bytes = F.sum("length").over(Window.partitionBy("chunk"))
    where = materialise(
        plan.select("file_path", "chunk", F.ceil(chunk_bytes / target_bytes).cast("int").alias("parts")),
        "chunk-parts",
    )
    total = where.select("chunk", "parts").distinct().agg(F.sum("parts")).first()[0]
    placed = rows.select(
        F.coalesce("id", "_id").alias("id"),
        "embedding",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.row_index").alias("row_index"),
    ).join(where, "file_path")
    part = F.pmod(F.xxhash64("file_path", "row_index"), F.col("parts"))
    (
        placed.withColumn("part", part)
        .repartition(int(total), "chunk", "part")
        .select("id", "embedding", "chunk")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("chunk")
        .parquet(path)
    )


def _read_wave(spark: SparkSession, part: DataFrame) -> DataFrame:
    paths = [escape_glob(row.path) for row in part.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], SHARD_SCHEMA)
    return spark.read.schema(SHARD_SCHEMA).option("ignoreCorruptFiles", "true").parquet(*paths)


def _write_wave(
    spark: SparkSession, part: DataFrame, path: str, target_bytes: int, layout: str
) -> int:
    """Write the rows of a wave's files and return how many there are."""
    rows = _read_wave(spark, part)
    if layout == "packed" or part.isEmpty():
        _write_packed(spark, rows, path, target_bytes)
    else:
        _write_chunks(rows, part, path, target_bytes)
    return spark.read.option("recursiveFileLookup", "true").schema(SHARD_SCHEMA).parquet(path).count()


def _damaged(spark: SparkSession, part: DataFrame) -> DataFrame:
    """Paths of files that give fewer rows than their footer says."""
    compared = part.join(rows_decoded(located(_read_wave(spark, part))), "file_path", "left")
    short = compared.where(F.coalesce("decoded", F.lit(0)) != F.col("rows"))
    return materialise(short.select("path", "_hash"), "damaged")


def compact(
    spark: SparkSession,
    source_dirs: list[str],
    output_dir: str,
    files_per_chunk: int = 10_000,
    chunks_per_wave: int = 10,
    target_bytes: int = 1 << 30,
    layout: str = "packed",
    ignore_extra: bool = False,
    chunk_bytes: int | None = None,
) -> Compaction:
    """Rewrite all shards not compacted yet; running again takes up only new files.

    Files are planned from their footers: unreadable ones and ones with another
    schema are reported, not read; so are files whose pages turn out damaged. Work goes in waves of ``chunks_per_wave`` chunks,
    which bounds the paths the driver handles at once; a wave's files enter the
    manifest only after its data is committed, and a wave that was cut off is
    written over. ``layout="packed"`` (no shuffle) fills files up to
    ``target_bytes``; ``layout="chunks"`` keeps one folder per chunk. With ``chunk_bytes`` chunks are cut by bytes instead of files.
    """
    manifest = read_manifest(spark, output_dir)
    done = manifest.agg(F.max("chunk").alias("chunk"), F.max("wave").alias("wave")).first()
    first_chunk = 0 if done.chunk is None else done.chunk + 1
    wave = 0 if done.wave is None else done.wave + 1

    pending = list_shards(spark, *source_dirs)
    if done.wave is not None:
        pending = skip_existing_chunks(pending, manifest)
    inspected = materialise(inspect_shards(pending, ignore_extra), "inspected")
    rejects = inspected.where(~F.col("conforms")).select("path", "readable", "columns", "error")
    good = inspected.where("conforms").select("path", "file_path", "length", "rows")
    plan = materialise(plan_compaction(good, files_per_chunk, first_chunk, chunk_bytes), "plan")
    totals = plan.agg(
        F.count("*").alias("files"), F.sum("rows").alias("rows"), F.max("chunk").alias("last_chunk")
    ).first()
    last = totals.last_chunk
    if last is None:
        if not inspected.isEmpty() and not inspected.where("readable").limit(1).count():
            raise ValueError("none of the files to compact could be read")
        return Compaction(0, 0, 0, 0, 0, rejects)

    written, first_wave = 0, wave
    for start in range(first_chunk, last + 1, chunks_per_wave):
        part = plan.where(F.col("chunk").between(start, start + chunks_per_wave - 1))
        target = _wave_dir(output_dir, wave)
        rows_in_wave = _write_wave(spark, part, target, target_bytes, layout)
        if rows_in_wave != part.agg(F.sum("rows")).first()[0]:
            # Pages of some file are damaged behind a good footer: leave such files out whole.
            damaged = _damaged(spark, part)
            part = materialise(part.join(damaged, "path", "left_anti"), "sound")
            rejects = rejects.unionByName(
                damaged.select(
                    "path",
                    F.lit(True).alias("readable"),
                    F.lit(None).cast("string").alias("columns"),
                    F.lit(DAMAGED).alias("error"),
                )
            )
            rows_in_wave = _write_wave(spark, part, target, target_bytes, layout)
        part.withColumn("wave", F.lit(wave).cast("bigint")).select(
            "path", "file_path", "length", "rows", "chunk", "wave"
        ).write.mode("append").parquet(f"{output_dir}/_manifest")
        written += rows_in_wave
        wave += 1
    return Compaction(
        totals.files, last - first_chunk + 1, wave - first_wave, totals.rows, written, rejects
    )
