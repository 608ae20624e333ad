"""The embedding step: batches to a provider, with retries and a dead letter."""

from __future__ import annotations

import re
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomvec.functions.once import with_once
from loomvec.functions.text import MAX_TOKENS, clean_text, has_text
from loomvec.functions.vectors import l2_normalize
from loomvec.operators.providers import HashingProvider, Provider

EMBEDDED_SCHEMA = (
    "id string, embedding array<float>, status string, error string, attempts int, endpoint string"
)
# Columns of request rows (status ``request``); null in all other rows.
REQUEST_SCHEMA = "request_id bigint, done_at timestamp, latency_ms double, docs int, tokens bigint, padded bigint"
_RESULT_FIELDS = [
    ("id", pa.string()),
    ("embedding", pa.list_(pa.float32())),
    ("status", pa.string()),
    ("error", pa.string()),
    ("attempts", pa.int32()),
    ("endpoint", pa.string()),
]
_REQUEST_FIELDS = [
    ("request_id", pa.int64()),
    ("done_at", pa.timestamp("us", tz="UTC")),
    ("latency_ms", pa.float64()),
    ("docs", pa.int32()),
    ("tokens", pa.int64()),
    ("padded", pa.int64()),
]
_ARROW_SCHEMA = pa.schema(_RESULT_FIELDS)
_LOGGED_SCHEMA = pa.schema(_RESULT_FIELDS + _REQUEST_FIELDS)


def prepare_texts(records: DataFrame, clean: bool = True) -> DataFrame:
    """``(id, text)`` rows worth embedding; text that cleans to nothing is dropped.

    Without cleaning only null and empty text is dropped, white space is kept.
    """
    rows = records.select("id", "text").where(has_text(F.col("text")))
    if clean:
        rows = with_once(rows, "text", clean_text(F.col("text"))).where(F.col("text") != "")
    return rows


def rotated_endpoint(
    partition: int | Column, batch: int | Column, attempt: int | Column, endpoints: int
):
    """Which endpoint a try uses; every retry moves on to the next one."""
    return (partition + batch + attempt) % endpoints


def _rebatch(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[list, list]]:
    """Regroup Arrow batches into lists of exactly ``size`` rows (the last may be short)."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def lists(parts: list[pa.RecordBatch]) -> tuple[list, list]:
        return tuple([x for part in parts for x in part.column(name).to_pylist()] for name in ("id", "text"))

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            held.append(batch.slice(at, size - rows))
            at += held[-1].num_rows
            rows += held[-1].num_rows
            if rows == size:
                yield lists(held)
                held, rows = [], 0
    if rows:
        yield lists(held)


@dataclass(frozen=True)
class Packing:
    """Batches of texts of like length, bounded by their padded size.

    A task holds back up to ``buffer_rows`` texts, or ``buffer_bytes`` of them if that is less, sorts them by their estimated
    tokens and fills batches from the shortest on, until one more text would take a batch, padded to its longest text, beyond
    ``padded_tokens`` or ``batch_size``. A text that is longer by itself is a batch of its own.
    """

    padded_tokens: int = 16_384
    buffer_rows: int = 4096
    buffer_bytes: int = 32 << 20


def _tokens(text: str) -> int:
    return min(MAX_TOKENS, len(text.split()))


def _packed(batches: Iterable[pa.RecordBatch], size: int, packing: Packing) -> Iterator[tuple[list, list]]:
    """Regroup Arrow batches into lists of at most ``size`` rows of like length; every row comes out once."""
    held: list[tuple[int, str | None, str]] = []
    held_bytes = 0

    def full(last: bool) -> Iterator[list[tuple[int, str | None, str]]]:
        """Batches of what is held, which keeps the batch that is not full unless ``last``."""
        nonlocal held, held_bytes
        held.sort(key=lambda row: row[0])
        at = 0
        for i, (tokens, _, _) in enumerate(held):
            if i > at and ((i - at + 1) * max(tokens, 1) > packing.padded_tokens or i - at == size):
                yield held[at:i]
                at = i
        if at == 0 or last:
            # Nothing was full: one batch goes out all the same, so that the buffer empties.
            if held[at:]:
                yield held[at:]
            at = len(held)
        held = held[at:]
        held_bytes = sum(len(text) for _, _, text in held)

    for batch in batches:
        for id_, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            held.append((_tokens(text), id_, text))
            held_bytes += len(text)
            if len(held) >= packing.buffer_rows or held_bytes >= packing.buffer_bytes:
                for rows in full(last=False):
                    yield [id_ for _, id_, _ in rows], [text for _, _, text in rows]
    for rows in full(last=True):
        yield [id_ for _, id_, _ in rows], [text for _, _, text in rows]


def _in_flight(work: Iterable[Callable], limit: int) -> Iterator:
    """Results of ``work`` in order, at most ``limit`` running at a time."""
    if limit <= 1:
        yield from (job() for job in work)
        return
    with ThreadPoolExecutor(limit) as pool:
        running: deque = deque()
        for job in work:
            running.append(pool.submit(job))
            if len(running) >= limit:
                yield running.popleft().result()
        while running:
            yield running.popleft().result()


def _bounded(rows: DataFrame, open_requests: int, in_flight: int) -> tuple[DataFrame, ResourceProfile | None]:
    """``rows`` and a resource profile under which at most ``open_requests // in_flight`` embedding tasks run at a time.

    Where ``spark.executor.instances`` and ``spark.executor.cores`` tell the slots of a cluster of fixed size, every task of the stage asks for so
    many cores that no more tasks fit; tasks stay as small as the scan made them. Elsewhere, as in local mode, the scan's
    splits are put together into that many tasks, without a shuffle.
    """
    if open_requests < in_flight:
        raise ValueError("a bound on open requests below those of one task")
    tasks = open_requests // in_flight
    context = rows.sparkSession.sparkContext
    conf = context.getConf()
    executors, cores = (int(conf.get(f"spark.executor.{name}", "0")) for name in ("instances", "cores"))
    moving = conf.get("spark.dynamicAllocation.enabled", "false") == "true"
    if re.fullmatch(r"local(\[.*\])?", context.master) or moving or not executors or not cores or tasks < executors:
        return rows.coalesce(tasks), None
    cpus = -(-cores // min(cores, tasks // executors))
    return rows, ResourceProfileBuilder().require(TaskResourceRequests().cpus(cpus)).build


def _vector_column(vectors, n: int) -> pa.Array:
    if len(vectors) != n:
        raise ValueError(f"{len(vectors)} vectors for {n} texts")
    if isinstance(vectors, np.ndarray):
        offsets = np.arange(n + 1, dtype=np.int32) * vectors.shape[1]
        return pa.ListArray.from_arrays(offsets, pa.array(vectors.astype(np.float32).ravel()))
    return pa.array(vectors, type=pa.list_(pa.float32()))


def _result(ids: list, vectors, status: str, error: str | None, attempts: int, endpoint: str | None):
    n = len(ids)
    columns = [
        pa.array(ids, pa.string()),
        vectors if vectors is not None else pa.nulls(n, pa.list_(pa.float32())),
        pa.array([status] * n, pa.string()),
        pa.array([error] * n, pa.string()),
        pa.array([attempts] * n, pa.int32()),
        pa.array([endpoint] * n, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW_SCHEMA)


def _logged(batch: pa.RecordBatch, requests: list[tuple]) -> pa.RecordBatch:
    """The batch's rows with one more per request that was made for it."""
    n = batch.num_rows
    empty = [None] * len(requests)
    facts = list(zip(*requests, strict=True))
    number, done, latency, docs, tokens, padded, error, attempt, endpoint = facts
    own = [empty, empty, ["request"] * len(requests), error, attempt, endpoint, number, done, latency, docs, tokens, padded]
    columns = []
    for field, values in zip(_LOGGED_SCHEMA, own, strict=True):
        before = batch.column(field.name) if field.name in batch.schema.names else pa.nulls(n, field.type)
        columns.append(pa.concat_arrays([before, pa.array(values, field.type)]))
    return pa.RecordBatch.from_arrays(columns, schema=_LOGGED_SCHEMA)


def embed_records(
    records: DataFrame,
    provider: Callable[[], Provider] = HashingProvider,
    endpoints: Sequence[str] = (),
    batch_size: int = 256,
    max_attempts: int = 3,
    retry_wait: float = 5.0,
    in_flight: int = 1,
    partitions: int | None = None,
    normalize: bool = False,
    log_requests: bool = False,
    packing: Packing | None = None,
    open_requests: int | None = None,
) -> DataFrame:
    """Embed ``(id, text)`` rows; every input row comes out once, ok or failed.

    Tasks stream: each regroups its Arrow batches into ``batch_size`` texts and
    keeps up to ``in_flight`` requests open, so total concurrency is running tasks
    times ``in_flight``. ``partitions`` spreads a small input over more tasks; by
    default the scan's own splits are kept and nothing is shuffled. A batch whose
    tries all raise, or whose answer does not line up with its texts, is returned
    with ``status = 'failed'`` instead of being lost. ``log_requests`` adds a row with
    ``status = 'request'`` for every try, and the columns of REQUEST_SCHEMA: when it ended, how long
    it took, its texts, their estimated tokens, and the tokens when all are padded to the longest; ``error`` is set if it failed.
    ``open_requests`` bounds the requests that all tasks of the run have open together (speculative copies of tasks aside).
    ``packing`` sends texts of like length together instead of in the order they come.
    """
    urls = list(endpoints)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        service = provider()
        context = TaskContext.get()
        task = context.partitionId() if context else 0

        def one(number: int, ids: list, texts: list):
            error, endpoint, requests = None, None, []

            def note(attempt: int, started: float, problem: str | None) -> None:
                lengths = [_tokens(text) for text in texts]
                ended = time.time()
                key = (task << 33) + number * max_attempts + attempt
                done = datetime.fromtimestamp(ended, timezone.utc)
                size = (len(ids), sum(lengths), len(ids) * max(lengths))
                requests.append((key, done, (ended - started) * 1000, *size, problem, attempt + 1, endpoint))

            def finished(*outcome) -> pa.RecordBatch:
                result = _result(ids, *outcome, endpoint)
                return _logged(result, requests) if log_requests else result

            for attempt in range(max_attempts):
                if urls:
                    endpoint = urls[rotated_endpoint(task, number, attempt, len(urls))]
                started = time.time()
                try:
                    vectors = service.embed(texts, endpoint)
                except Exception as problem:
                    error = f"{type(problem).__name__}: {problem}"
                    note(attempt, started, error)
                    if attempt + 1 < max_attempts:
                        time.sleep(retry_wait)
                    continue
                try:
                    column = _vector_column(vectors, len(ids))
                except Exception as problem:
                    error = f"bad response: {problem}"
                    note(attempt, started, error)
                    return finished(None, "failed", error, attempt + 1)
                note(attempt, started, None)
                return finished(column, "ok", None, attempt + 1)
            return finished(None, "failed", error, max_attempts)

        work = (
            lambda number=number, ids=ids, texts=texts: one(number, ids, texts)
            for number, (ids, texts) in enumerate(
                _rebatch(batches, batch_size) if packing is None else _packed(batches, batch_size, packing)
            )
        )
        yield from _in_flight(work, in_flight)

    rows = records.select(F.col("id").cast("string").alias("id"), "text")
    if partitions:
        rows = rows.repartition(partitions)
    rows, profile = (rows, None) if open_requests is None else _bounded(rows, open_requests, in_flight)
    schema = f"{EMBEDDED_SCHEMA}, {REQUEST_SCHEMA}" if log_requests else EMBEDDED_SCHEMA
    embedded = rows.mapInArrow(run, schema, profile=profile)
    if normalize:
        embedded = embedded.withColumn("embedding", l2_normalize(F.col("embedding")))
    return embedded


def embedded_ok(embedded: DataFrame) -> DataFrame:
    return embedded.where(F.col("status") == "ok").select("id", "embedding")


def dead_letter(embedded: DataFrame) -> DataFrame:
    return embedded.where(F.col("status") == "failed").select("id", "error", "attempts", "endpoint")
