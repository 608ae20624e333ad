"""Incremental embedding: a file stream of records into a table of embeddings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loomvec.operators.embed import embed_records, prepare_texts
from loomvec.operators.providers import HashingProvider, Provider
from loomvec.sources.records import judge_lines, records_of
from loomvec.streaming.progress import counted


def record_stream(
    spark: SparkSession, directory: str, max_files: int | None = None, require_text: bool = True
) -> DataFrame:
    """``(id, text)`` of JSONL files as they arrive; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return records_of(judge_lines(reader.text(directory), require_text))


def embed_stream(
    records: DataFrame,
    output: str,
    checkpoint: str,
    provider: Callable[[], Provider] = HashingProvider,
    clean: bool = True,
    available_now: bool = True,
    **embed_options,
) -> StreamingQuery:
    """Embed a record stream into Parquet under ``status=ok`` and ``status=failed``.

    A restart with the same checkpoint goes on after the last committed batch; the
    file sink makes each batch's rows visible exactly once. Micro-batches report their ok and failed rows to listeners (see
    :mod:`loomvec.streaming.progress`).
    """
    embedded = counted(embed_records(prepare_texts(records, clean), provider, **embed_options))
    writer = (
        embedded.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .partitionBy("status")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
