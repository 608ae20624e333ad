"""Progress of a running embedding stream, as rows."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from loomvec.operators.request_log import per_second, seconds

PROGRESS_SCHEMA = "query string, batch bigint, started timestamp, ended timestamp, rows bigint, ok bigint, failed bigint"
METRIC = "embedded"


def counted(embedded: DataFrame) -> DataFrame:
    """Embedded rows whose ok and failed ones are counted on the way, per micro-batch."""
    return embedded.observe(METRIC, *[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "failed")])


class Progress(StreamingQueryListener):
    """Collects a row per micro-batch of the queries that use :func:`counted`, and hands each to ``tell`` as it comes.

    It keeps the last ``most`` rows; ``save`` appends those not saved yet to a table.
    """

    def __init__(self, tell: Callable[[tuple], None] | None = None, most: int = 100_000):
        self._lock = threading.Lock()
        self._kept: deque[tuple] = deque(maxlen=most)
        self._saved = 0
        self._seen = 0
        self._ended: set[str] = set()
        self.tell = tell

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = p.observedMetrics.get(METRIC)
        if found is None:
            return
        started = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        ended = datetime.fromtimestamp(started.timestamp() + p.batchDuration / 1000, timezone.utc)
        row = (str(p.name or p.id), p.batchId, started, ended, p.numInputRows, found["ok"], found["failed"])
        with self._lock:
            self._kept.append(row)
            self._seen += 1
        if self.tell:
            self.tell(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.id))

    def ended(self, query) -> bool:
        """Whether the news of the query's end, and so of all its micro-batches, has come."""
        with self._lock:
            return str(query.id) in self._ended

    def rows(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            return spark.createDataFrame(list(self._kept), PROGRESS_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> int:
        """Append the rows since the last call; how many there were."""
        with self._lock:
            new = list(self._kept)[max(0, len(self._kept) - (self._seen - self._saved)) :]
            self._saved = self._seen
        if new:
            spark.createDataFrame(new, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        return len(new)


def await_news(progress: Progress, query, longest: float = 30.0) -> bool:
    """Wait until the listener knows that the query ended; news come a little after the fact."""
    until = time.time() + longest
    while not progress.ended(query) and time.time() < until:
        time.sleep(0.05)
    return progress.ended(query)


def progress_rates(progress: DataFrame) -> DataFrame:
    """Progress rows with the running total of ``ok``, and rates of the micro-batch and since the query's first one."""
    whole = Window.partitionBy("query")
    upto = whole.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    began, ended = seconds(F.col("started")), seconds(F.col("ended"))
    return progress.withColumns({
        "processed": F.sum("ok").over(upto),
        "docs_s": per_second(F.col("ok"), ended - began),
        "avg_docs_s": per_second(F.sum("ok").over(upto), ended - F.min(began).over(whole)),
    })
