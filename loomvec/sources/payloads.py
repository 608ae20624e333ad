"""Upload payloads for a vector store: files of JSON, each within a size the store takes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomvec.functions.vectors import point_json

# What a payload is, apart from its points and the commas between them.
_HEAD, _TAIL = '{"points":[', "]}"
PAYLOAD_SCHEMA = "points array<struct<id: string, embedding: array<float>>>"


def payloads(vectors: DataFrame, most_bytes: int = 4 << 20, most_points: int = 1000, id_: str = "id", vector: Column | str = "embedding") -> DataFrame:
    """``(value)``: payloads of ``vectors``, in the order of each partition; nothing is shuffled.

    A payload with its line end takes at most ``most_bytes`` and holds at most ``most_points``. A point that is larger by itself is an
    error that names its id. Vectors are rendered by the JVM; a task holds one payload at a time.
    """
    vector = F.col(vector) if isinstance(vector, str) else vector
    points = vectors.select(F.col(id_).cast("string").alias("id"), point_json(F.col(id_).cast("string"), vector).alias("point"))
    frame = len(_HEAD) + len(_TAIL) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], frame

        def payload() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([_HEAD + ",".join(held) + _TAIL])], names=["value"])

        for batch in batches:
            for name, point in zip(batch.column("id").to_pylist(), batch.column("point").to_pylist()):
                length = len(point.encode())
                if frame + length > most_bytes:
                    raise ValueError(f"the point {name!r} takes {length} bytes, a payload at most {most_bytes}")
                if held and (size + 1 + length > most_bytes or len(held) == most_points):
                    yield payload()
                    held, size = [], frame
                size += length + (1 if held else 0)
                held.append(point)
        if held:
            yield payload()

    return points.mapInArrow(pack, "value string")


def write_payloads(made: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One payload a file. Files appear when the job commits; of failed tasks and jobs nothing stays."""
    made.write.mode(mode).option("maxRecordsPerFile", 1).text(path)


def payload_stream(made: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """The same for a stream of vectors; each micro-batch's files count once."""
    writer = made.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint).option("maxRecordsPerFile", 1)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, length, id, embedding)`` of all points in payload files."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("length"),
        F.from_json("value", PAYLOAD_SCHEMA, {"mode": "FAILFAST"}).alias("payload"),
    )
    return lines.select("file_path", "length", F.inline("payload.points"))
