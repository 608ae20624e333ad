"""Embedding tables on disk: writing, reading, listing and inspecting Parquet shards."""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomvec.session import materialise, scratch_path, session_conf

EMBEDDED_TABLE_SCHEMA = (
    "id string, embedding array<float>, error string, attempts int, endpoint string, request_id bigint, "
    "done_at timestamp, latency_ms double, docs int, tokens bigint, padded bigint, status string"
)
# Both spellings of the id column are read; a file has one of them.
SHARD_SCHEMA = "id string, _id string, embedding array<float>"
INSPECTED_SCHEMA = (
    "path string, file_path string, dir string, length bigint, "
    "readable boolean, rows bigint, columns string, conforms boolean, error string"
)


def write_embeddings(embedded: DataFrame, path: str, mode: str = "append") -> dict[str, int]:
    """Write embedded rows once, as zstd Parquet under ``status=ok`` and ``status=failed``.

    The provider is called in this one job; ok rows and the dead letter are then
    read from the table. Open writers replace the sort by status Spark would add.
    Returns how many rows were ``ok`` and ``failed``, counted on the way.
    """
    seen = Observation()
    counted = embedded.observe(
        seen, *[F.count_if(F.col("status") == status).alias(status) for status in ("ok", "failed")]
    )
    with session_conf(embedded.sparkSession, maxConcurrentOutputFileWriters="4"):
        counted.write.mode(mode).option("compression", "zstd").partitionBy("status").parquet(path)
    return dict(seen.get)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """``(id, embedding)`` of a table written by :func:`write_embeddings`."""
    table = spark.read.schema(EMBEDDED_TABLE_SCHEMA).parquet(path)
    return table.where(F.col("status") == "ok").select("id", "embedding")


def read_dead_letter(spark: SparkSession, path: str) -> DataFrame:
    """``(id, error, attempts, endpoint)`` of ids that never succeeded: the last failure of each."""
    table = spark.read.schema(EMBEDDED_TABLE_SCHEMA).parquet(path)
    failed = table.where(F.col("status") == "failed")
    # Runs append files, so a later failure is in a younger file.
    facts = F.struct("error", "attempts", "endpoint")
    last = failed.groupBy("id").agg(F.max_by(facts, F.struct(F.col("_metadata.file_modification_time"), "attempts")).alias("last"))
    ok = table.where(F.col("status") == "ok").select(F.col("id").alias("_ok"))
    return last.join(ok, F.col("id").eqNullSafe(F.col("_ok")), "left_anti").select("id", "last.*")


def read_request_log(spark: SparkSession, path: str, batch: int, conc: int, trial_no: int = 1) -> DataFrame:
    """The requests of an embedding run that logged them, as the log of one trial.

    ``request_id`` is unique within a run; give each run a table, and a ``trial_no``, of its own.
    """
    table = spark.read.schema(EMBEDDED_TABLE_SCHEMA).parquet(path).where(F.col("status") == "request")
    return table.select(
        "request_id", F.lit(trial_no).alias("trial_no"), F.lit(batch).alias("batch"), F.lit(conc).alias("conc"),
        "done_at", "latency_ms", "docs", "tokens", F.col("error").isNotNull().cast("int").alias("error"),
    )


def escape_glob(path: str) -> str:
    """A listed file's path, so that none of its characters act as a wildcard."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_shards(spark: SparkSession, *paths: str, skip_bad: bool = False) -> DataFrame:
    """``(id, embedding)`` of the Parquet files in all of ``paths``: a bag union.

    Directories are not searched below their own level; ``_id`` is read as ``id``.
    A file that cannot be read is an error, unless ``skip_bad``: then files that
    :func:`rejected_shards` reports are left out whole.
    """
    reader = spark.read.schema(SHARD_SCHEMA).option("pathGlobFilter", "*.parquet")
    if not skip_bad:
        return _ids_unified(reader.parquet(*paths))
    judged = _judged(spark, *paths)
    good = materialise(judged.where("error IS NULL").select("file_path"), "good-files")
    rows = located(reader.option("ignoreCorruptFiles", "true").parquet(*paths))
    return _ids_unified(rows.join(good, "file_path", "left_semi"))


DAMAGED = "damaged data pages"
NOT_A_SHARD = "not the columns of a shard"


def located(rows: DataFrame) -> DataFrame:
    """Rows of a scan of SHARD_SCHEMA with their ``file_path``."""
    return rows.select("id", "_id", "embedding", F.col("_metadata.file_path").alias("file_path"))


def rows_decoded(rows: DataFrame) -> DataFrame:
    """``(file_path, decoded)``: rows that really come out of each file of :func:`located`."""
    # The hash makes the scan decode every page, as long as it is used.
    return rows.groupBy("file_path").agg(
        F.count("*").alias("decoded"), F.max(F.xxhash64("id", "_id", "embedding")).alias("_hash")
    )


def _judged(spark: SparkSession, *paths: str) -> DataFrame:
    """The inspected files, with an error for each that is unreadable, damaged or no shard."""
    # Overlapping paths list, and read, a file several times.
    listing = list_shards(spark, *paths).groupBy("path", "file_path", "dir", "length").agg(F.count("*").alias("copies"))
    listing = materialise(listing, "listing")
    inspected = inspect_shards(listing).join(listing.select("file_path", "copies"), "file_path")
    inspected = materialise(inspected, "inspected")
    # Scanning only files with the right columns: a wrong type would fail the scan.
    good = inspected.where("conforms").select("file_path")
    read = spark.read.schema(SHARD_SCHEMA).option("pathGlobFilter", "*.parquet").option("ignoreCorruptFiles", "true")
    decoded = rows_decoded(located(read.parquet(*paths)).join(good, "file_path", "left_semi"))
    judged = inspected.join(decoded, "file_path", "left")
    error = (
        F.when(~F.col("readable"), F.coalesce("error", F.lit("unreadable")))
        .when(~F.col("conforms"), NOT_A_SHARD)
        .when(F.coalesce("decoded", F.lit(0)) != F.col("rows") * F.col("copies"), DAMAGED)
    )
    # Written with the hash: left out, nothing would be decoded.
    return materialise(judged.select("path", "file_path", "columns", error.alias("error"), "_hash"), "judged")


def rejected_shards(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path, columns, error)`` of the files that ``read_shards(skip_bad=True)`` leaves out."""
    return _judged(spark, *paths).where("error IS NOT NULL").select("path", "columns", "error")


def _ids_unified(rows: DataFrame) -> DataFrame:
    return rows.select(F.coalesce("id", "_id").alias("id"), "embedding")


def list_shards(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, file_path, dir, length`` of each Parquet file; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(paths))
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("file_path"),
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"),
        "length",
    )


def files_per_dir(listing: DataFrame) -> DataFrame:
    return listing.groupBy("dir").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


# Files up to this size are read whole, on the executors, for their footer; the driver names so many paths at a time.
WHOLE_BYTES = 32 << 20
FILES_PER_WAVE = 20_000
_ASKED_AT_ONCE = 16


def _footer_bytes(content: Column, length: Column) -> Column:
    """The end of a Parquet file from its footer on, or its last bytes if they name no footer inside the file."""
    tail = F.greatest(length - 7, F.lit(1)).cast("int")
    size = sum(
        (F.conv(F.hex(F.substring(content, tail + i, F.lit(1))), 16, 10).cast("bigint") * (1 << 8 * i) for i in range(4)), F.lit(0)
    )
    whole = F.when(size + 8 <= length, size + 8).otherwise(8)
    return F.substring(content, F.greatest(length - whole + 1, F.lit(1)).cast("int"), whole.cast("int"))


def _parsed_footer(footer: bytes | None) -> pq.FileMetaData:
    return pq.ParquetFile(pa.BufferReader(b"PAR1" + bytes(footer or b""))).metadata


def _conforms(schema: pa.Schema, ignore_extra: bool) -> bool:
    columns = {field.name: field.type for field in schema}
    ids = [columns[name] for name in ("id", "_id") if name in columns]
    vector = columns.get("embedding")
    return (
        len(ids) == 1
        and (pa.types.is_string(ids[0]) or pa.types.is_large_string(ids[0]))
        and vector is not None
        and (
            pa.types.is_list(vector)
            or pa.types.is_large_list(vector)
            or pa.types.is_fixed_size_list(vector)
        )
        and pa.types.is_float32(vector.value_type)
        and (ignore_extra or len(columns) == 2)
    )


def _arrow_name(kind: T.DataType) -> str:
    """A Spark type as small files' footers show it."""
    if isinstance(kind, T.ArrayType):
        return f"list<element: {_arrow_name(kind.elementType)}>"
    return {"bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8", "boolean": "bool"}.get(kind.simpleString(), kind.simpleString())


def _inspect_small(files: DataFrame, ignore_extra: bool) -> DataFrame:
    def inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for footer in batch.pop("footer"):
                try:
                    read = _parsed_footer(footer)
                    schema = read.schema.to_arrow_schema()
                    columns = ", ".join(f"{field.name}: {field.type}" for field in schema)
                    found.append((True, read.num_rows, columns, _conforms(schema, ignore_extra), None))
                except (pa.ArrowException, OSError) as problem:
                    found.append((False, None, None, False, f"{type(problem).__name__}: {problem}"))
            facts = pd.DataFrame(found, columns=["readable", "rows", "columns", "conforms", "error"])
            facts["rows"] = facts["rows"].astype("Int64")
            yield pd.concat([batch.reset_index(drop=True), facts], axis=1)

    return files.mapInPandas(inspect, INSPECTED_SCHEMA)


def _inspect_large(spark: SparkSession, files: DataFrame, ignore_extra: bool) -> DataFrame:
    """Columns from one schema read per file, rows from one scan of all footers; no data page is read."""
    paths = [row.path for row in files.select("path").collect()]

    def ask(path: str) -> tuple:
        try:
            fields = spark.read.parquet(escape_glob(path)).schema.fields
        except Exception as problem:
            # Anything but a broken footer, as trouble with the store, is no fact about the file.
            if "FOOTER" not in str(problem) and "UNABLE_TO_INFER_SCHEMA" not in str(problem) and "is not a Parquet file" not in str(problem):
                raise
            return path, False, None, False, f"{type(problem).__name__}: {str(problem).splitlines()[0]}"
        named = {field.name: field.dataType for field in fields}
        ids = [named[name] for name in ("id", "_id") if name in named]
        good = len(ids) == 1 and ids[0] == T.StringType() and (ignore_extra or len(named) == 2)
        good = good and isinstance(named.get("embedding"), T.ArrayType) and named["embedding"].elementType == T.FloatType()
        return path, True, ", ".join(f"{f.name}: {_arrow_name(f.dataType)}" for f in fields), good, None

    with ThreadPoolExecutor(_ASKED_AT_ONCE) as pool:
        facts = list(pool.map(ask, paths))
    known = spark.createDataFrame(facts, "path string, readable boolean, columns string, conforms boolean, error string")
    scan = spark.read.schema(SHARD_SCHEMA).option("ignoreCorruptFiles", "true").parquet(*map(escape_glob, paths))
    counts = scan.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("rows"))
    rows = F.when(F.col("readable"), F.coalesce("rows", F.lit(0)))
    whole = files.join(known, "path").join(counts, "file_path", "left").withColumn("rows", rows)
    return whole.select("path", "file_path", "dir", "length", "readable", "rows", "columns", "conforms", "error")


def inspect_shards(
    listing: DataFrame, ignore_extra: bool = False, whole_bytes: int = WHOLE_BYTES, files_per_wave: int = FILES_PER_WAVE
) -> DataFrame:
    """Per file: readable or not, rows, columns, and whether it has the shard schema.

    Only Spark opens files, with its own credentials and file systems. Of files up to ``whole_bytes`` the executors read the content and hand
    the footer alone to Python. Larger files, of which there are few, are asked for their schema one by one, and
    counted by a scan that needs no column. Paths pass through the driver ``files_per_wave`` at a time.
    """
    spark = listing.sparkSession
    listed = materialise(listing.select("path", "file_path", "dir", "length").distinct(), "to-inspect")
    path = scratch_path(spark, "inspected")
    spark.createDataFrame([], INSPECTED_SCHEMA).write.parquet(f"{path}/wave=0")
    names = (row.path for row in listed.select("path").distinct().toLocalIterator())
    for wave in iter(lambda: list(islice(names, files_per_wave)), []):
        own = spark.read.format("binaryFile").load([escape_glob(name) for name in wave])
        footer = _footer_bytes(F.col("content"), F.col("length")).alias("footer")
        facts = ("path", F.col("_metadata.file_path").alias("file_path"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"), "length")
        small = own.where(F.col("length") <= whole_bytes).select(*facts, footer)
        _inspect_small(small, ignore_extra).write.mode("append").parquet(f"{path}/wave=1")
        large = own.where(F.col("length") > whole_bytes).select(*facts)
        if not large.isEmpty():
            _inspect_large(spark, large, ignore_extra).write.mode("append").parquet(f"{path}/wave=2")
    return spark.read.schema(INSPECTED_SCHEMA).parquet(f"{path}/wave=*")
