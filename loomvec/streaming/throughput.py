"""Rates and latencies over a stream of finished requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomvec.operators.request_log import per_second, seconds

# Size of the latency sketches: their rank error is about 2.3 / SKETCH_SIZE ** 0.9, less than 0.3 %.
SKETCH_SIZE = 2000

PERCENTILES = {"p50_ms": 0.5, "p95_ms": 0.95}


def throughput_stream(
    requests: DataFrame,
    every: str = "5 seconds",
    late_by: str = "1 minute",
    keys: Sequence[str] = (),
    sketch_size: int = SKETCH_SIZE,
) -> DataFrame:
    """Docs, tokens, errors and latencies per tumbling window of ``done_at`` (and per key).

    ``latency`` is a mergeable quantile sketch of ``latency_ms``, whose size does not follow the number of requests; ``began`` and
    ``ended`` are the seconds between which the window's requests ran. Requests that come more than ``late_by`` after
    younger ones are dropped once their window is closed; :func:`finish` counts them.
    """
    return (
        requests.withWatermark("done_at", late_by)
        .groupBy(F.window("done_at", every), *keys)
        .agg(
            F.sum("docs").cast("bigint").alias("docs"),
            F.sum("tokens").cast("bigint").alias("tokens"),
            F.sum("error").cast("bigint").alias("errors"),
            F.min(seconds(F.col("done_at")) - F.col("latency_ms") / 1000).alias("began"),
            F.max(seconds(F.col("done_at"))).alias("ended"),
            F.kll_sketch_agg_double(F.col("latency_ms").cast("double"), F.lit(sketch_size)).alias("latency"),
        )
        .select(F.col("window.start").alias("tick_start"), *keys, "docs", "tokens", "errors", "began", "ended", "latency")
    )


def write_updates(
    rates: DataFrame, output: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Write each micro-batch's changed windows under ``update=<batch>``.

    A batch that is run again after a failure replaces its own folder.
    """

    def save(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{output}/update={batch}")

    writer = rates.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def finish(query: StreamingQuery) -> dict[str, int]:
    """Wait for the query; ``rows`` it read, ``batches`` that held rows, and ``late`` rows the watermark dropped.

    Spark counts late rows behind the partial aggregation: those of one window and key in one task count once. It keeps the
    progress of a query's last ``spark.sql.streaming.numRecentProgressUpdates`` micro-batches.
    """
    query.awaitTermination()
    progress = query.recentProgress
    return {
        "rows": sum(p["numInputRows"] for p in progress),
        "batches": sum(1 for p in progress if p["numInputRows"]),
        "late": sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]),
    }


def read_latest(spark: SparkSession, output: str, keys: Sequence[str] = ()) -> DataFrame:
    """The newest state of every window written by :func:`write_updates`."""
    updates = spark.read.parquet(output)
    values = [c for c in updates.columns if c not in ("tick_start", "update", *keys)]
    newest = F.max_by(F.struct(*values), "update").alias("v")
    return updates.groupBy("tick_start", *keys).agg(newest).select("tick_start", *keys, "v.*")


def _percentile(sketch: Column, rank: float) -> Column:
    """A percentile of a sketch; 0.0 without a sample, as in the batch reports."""
    some = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(some, F.kll_sketch_get_quantile_double(sketch, F.lit(rank))).otherwise(F.lit(0.0))


def with_latency(ticks: DataFrame) -> DataFrame:
    """The p50 and p95 of each tick's latencies, in place of their sketch."""
    return ticks.withColumns({name: _percentile(F.col("latency"), p) for name, p in PERCENTILES.items()}).drop("latency")


def latency_so_far(ticks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per key the number of requests and their p50 and p95, from the ticks' sketches alone."""
    merged = ticks.groupBy(*keys).agg(F.kll_merge_agg_double("latency").alias("latency"))
    return with_latency(merged.withColumn("n", F.kll_sketch_get_n_double("latency")))


def with_rates(ticks: DataFrame, every_secs: int, keys: Sequence[str] = ()) -> DataFrame:
    """Per-second rates of each tick, and docs so far per key.

    As in the batch report, a tick's rates divide by the part of it that lies between the run's first request's start
    and its last one's end.
    """
    whole, upto = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("tick_start").rowsBetween(Window.unboundedPreceding, 0)
    start = seconds(F.col("tick_start"))
    first = F.min("tick_start").over(whole) == F.col("tick_start")
    since = F.when(first, F.min("began").over(whole)).otherwise(start)
    covered = F.least(start + every_secs, F.max("ended").over(whole)) - since
    return ticks.withColumns(
        {
            "docs_s": per_second(F.col("docs"), covered),
            "toks_s": per_second(F.col("tokens"), covered),
            "total_docs": F.sum("docs").over(upto),
        }
    ).drop("began", "ended")
