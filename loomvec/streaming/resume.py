"""Embedding a stream once per id: skips what is done, remembers what it saw, takes up what failed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomvec.operators.embed import embed_records, prepare_texts
from loomvec.operators.providers import HashingProvider, Provider
from loomvec.session import file_system, path_exists, scratch_path
from loomvec.sources.shards import EMBEDDED_TABLE_SCHEMA, write_embeddings

# Records whose embedding failed, with their text, as they wait for another round.
RETRY_SCHEMA = "id string, text string, round int"


def retry_stream(spark: SparkSession, retry: str, max_files: int | None = None) -> DataFrame:
    """The records that earlier micro-batches failed to embed, as they are written."""
    if not path_exists(spark, retry):
        spark.createDataFrame([], RETRY_SCHEMA).write.mode("ignore").parquet(retry)
    reader = spark.readStream.schema(RETRY_SCHEMA).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(retry)


def embed_once(
    records: DataFrame,
    output: str,
    retry: str,
    checkpoint: str,
    provider: Callable[[], Provider] = HashingProvider,
    done: DataFrame | None = None,
    remember: str = "7 days",
    max_rounds: int = 5,
    clean: bool = True,
    available_now: bool = True,
    **embed_options,
) -> StreamingQuery:
    """Embed each id of a record stream once into ``output``, a table that ``write_embeddings`` could have written.

    Left out are ids of ``done`` (a table of earlier runs, joined anew with every micro-batch), and ids the stream brought before: keyed state
    keeps an id for ``remember`` after it came last seen as new, by the clock, so that no record is ever too late. Records without an id have nothing to be
    known by and all pass. What fails goes to ``retry`` with its text; that folder is a second source of the
    same stream, so failed records come back, without asking the state, in a later micro-batch (with ``available_now``: of the next start), at most
    ``max_rounds`` times. Then they stay in the dead letter.

    A micro-batch that is run again after a crash writes its own folders over.
    """
    spark = records.sparkSession
    fresh = prepare_texts(records, clean)
    if done is not None:
        fresh = fresh.join(done.select("id").where("id IS NOT NULL").distinct(), "id", "left_anti")
    # Records without an id get a key of their own.
    known_by = F.struct("id", F.when(F.col("id").isNull(), F.uuid()).alias("own"))
    named = fresh.withColumn("_key", known_by).withColumn("_came", F.current_timestamp()).withWatermark("_came", remember)
    named = named.dropDuplicatesWithinWatermark(["_key"]).withColumn("round", F.lit(0))
    waiting = retry_stream(spark, retry).where(F.col("round") <= max_rounds)
    both = named.select("id", "text", "round").unionByName(waiting)

    def save(batch: DataFrame, number: int) -> None:
        # Written once: the source, and the state behind the batch, are not asked again.
        held = scratch_path(spark, "micro-batch")
        batch.write.parquet(held)
        rows = spark.read.schema(RETRY_SCHEMA).parquet(held)
        path = f"{output}/batch={number}"
        write_embeddings(embed_records(rows.select("id", "text"), provider, **embed_options), path, mode="overwrite")
        failed = spark.read.schema(EMBEDDED_TABLE_SCHEMA).parquet(path).where("status = 'failed'").select(F.col("id").alias("_failed")).distinct()
        again = rows.join(failed, F.col("id").eqNullSafe(F.col("_failed")), "left_semi")
        again.select("id", "text", (F.col("round") + 1).cast("int").alias("round")).write.mode("overwrite").parquet(f"{retry}/batch={number}")
        files, where = file_system(spark, held)
        files.delete(where, True)

    writer = both.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
