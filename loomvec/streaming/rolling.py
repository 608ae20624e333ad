"""Rolling latency over a stream: each run's last requests as keyed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from loomvec.operators.request_log import ROLLING_ROWS, RUN
from loomvec.session import session_conf

# Keyed state of any shape needs this state store.
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastRequests(StatefulProcessor):
    """Per run: a ring of the latencies of its last ``rows`` requests, and the requests of ticks still open.

    A tick closes when the watermark passes its end, so that its requests can be put in order of completion; the
    timer of the first such tick closes all of them. A micro-batch adds one state row per tick.
    """

    def __init__(self, rows: int, every_secs: int, keys: Sequence[str]):
        self.rows, self.width, self.keys = rows, every_secs * 1000, list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", "seen bigint, latency array<double>")
        self.open = handle.getListState("open", "tick bigint, done array<bigint>, request array<bigint>, latency array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        added = []
        for tick, part in batch.groupby(batch["done_micros"] // (self.width * 1000)):
            added.append((int(tick), *[part[name].tolist() for name in ("done_micros", "request_id", "latency_ms")]))
            self.handle.registerTimer((int(tick) + 1) * self.width)
        self.open.appendList(added)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held: dict[int, list] = {}
        still = []
        for tick, *columns in self.open.get():
            if (tick + 1) * self.width <= passed:
                held.setdefault(tick, []).append(columns)
            else:
                still.append((tick, *[list(c) for c in columns]))
        if not held:
            return
        seen, ring = self.ring.get() if self.ring.exists() else (0, [])
        ring = np.asarray(ring, dtype=np.float64)
        out = []
        for tick in sorted(held):
            done, request, latency = (np.concatenate([np.asarray(part[i]) for part in held[tick]]) for i in range(3))
            order = np.lexsort((request, done))
            seen += len(order)
            ring = np.concatenate((ring, latency[order].astype(np.float64)))[-self.rows :]
            p50, p95 = np.percentile(ring, [50, 95])
            out.append((*key, pd.Timestamp(tick * self.width, unit="ms"), min(seen, self.rows), p50, p95))
        self.ring.update((seen, ring.tolist()))
        if still:
            self.open.put(still)
        else:
            self.open.clear()
        yield pd.DataFrame(out, columns=[*self.keys, "tick_start", "samples", "p50_ms", "p95_ms"])

    def close(self) -> None:
        pass


def rolling_stream(
    requests: DataFrame, every_secs: int = 5, late_by: str = "1 minute", keys: Sequence[str] = RUN, rows: int = ROLLING_ROWS
) -> DataFrame:
    """At the end of each tick with requests: p50 and p95 over the run's last ``rows`` requests.

    Equal to :func:`loomvec.operators.request_log.rolling_latency_at_ticks` for ticks that the watermark has passed, however the
    requests are dealt to micro-batches. Requests with a null latency or time take no part.
    """
    keys = list(keys)
    asked = requests.withWatermark("done_at", late_by).where("done_at IS NOT NULL AND latency_ms IS NOT NULL")
    asked = asked.select(
        *keys, "done_at", F.unix_micros("done_at").alias("done_micros"), F.col("request_id").cast("bigint").alias("request_id"),
        F.col("latency_ms").cast("double").alias("latency_ms"),
    )
    fields = [T.StructField("tick_start", T.TimestampType()), T.StructField("samples", T.LongType())]
    fields += [T.StructField(name, T.DoubleType()) for name in ("p50_ms", "p95_ms")]
    schema = T.StructType([*[asked.schema[k] for k in keys], *fields])
    return asked.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=LastRequests(rows, every_secs, keys), outputStructType=schema, outputMode="append", timeMode="EventTime"
    )


def write_ticks(ticks: DataFrame, output: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append closed ticks as Parquet, each exactly once; a restart with the same checkpoint goes on with the kept state."""
    writer = ticks.writeStream.format("parquet").outputMode("append").option("path", output).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with session_conf(ticks.sparkSession, **{"streaming.stateStore.providerClass": _STATE_STORE}):
        return writer.start()


def read_ticks(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(output)
