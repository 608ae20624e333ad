"""Structured Streaming runs over files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomvec.operators.embed import embed_records, prepare_texts
from loomvec.plans.catalog.embedding import FAILS_SQL
from loomvec.plans.catalog.registry import (
    CLEAN_DOCUMENTS_SQL,
    documents,
    hashed_sql,
    query,
    rendered,
    rendered_sql,
    table,
)
from loomvec.plans.catalog.requests import LOG_SQL, ROLLING_TICKS_SQL, TICKS_SQL, log
from loomvec.plans.catalog.stand_ins import DIMS, Hashing, SomeTextsFail
from loomvec.session import scratch_path
from loomvec.sources.shards import EMBEDDED_TABLE_SCHEMA, read_embeddings, write_embeddings
from loomvec.streaming import progress, records, resume, rolling, throughput

# Text in one of the files that a stream takes a part at a time.
FILE_BYTES = 32 << 20


@query(f"SELECT id, {rendered_sql('embedding')} AS vector FROM ({hashed_sql(CLEAN_DOCUMENTS_SQL, DIMS)})")
def embed_stream(spark, sf_dir):
    """A stream over the documents as JSONL files, a few per micro-batch."""
    base = scratch_path(spark, "embed-stream")
    line = F.to_json(F.struct(F.col("doc_id").alias("_id"), "text"))
    lines = table(spark, sf_dir, "documents").select(line.alias("value"))
    lines.write.option("maxRecordsPerFile", 100_000).text(f"{base}/in")
    stream = records.record_stream(spark, f"{base}/in", max_files=100)
    records.embed_stream(stream, f"{base}/out", f"{base}/checkpoint", Hashing).awaitTermination()
    embedded = read_embeddings(spark, f"{base}/out")
    return embedded.select("id", rendered(F.col("embedding")).alias("vector"))


def _phases(spark, sf_dir):
    """The request log in three parts: its first half by time, the rest, and late copies of each run's first request."""
    requests = log(spark, sf_dir).select("trial_no", "request_id", "done_at", "latency_ms", "docs", "tokens", "error")
    first, last = requests.agg(F.min("done_at"), F.max("done_at")).first()
    half = F.lit(first + (last - first) / 2)
    late = requests.groupBy("trial_no").agg(F.min_by(F.struct(*requests.columns[1:]), F.struct("done_at", "request_id")).alias("r"))
    return [requests.where(F.col("done_at") < half), requests.where(F.col("done_at") >= half), late.select("trial_no", "r.*")]


def _run_in_phases(spark, sf_dir, name, start):
    """A stream that stops after each part of the log and goes on with the next one; what each run counted."""
    base = scratch_path(spark, name)
    counts = []
    for part in _phases(spark, sf_dir):
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(part.schema).parquet(f"{base}/in")
        counts.append(throughput.finish(start(stream, f"{base}/out", f"{base}/checkpoint")))
    return base, counts


def _hourly(stream, output, checkpoint):
    rates = throughput.throughput_stream(stream, "1 hour", late_by="1 hour", keys=["trial_no"])
    return throughput.write_updates(rates, output, checkpoint)


def _stopped_twice(spark, sf_dir):
    base, counts = _run_in_phases(spark, sf_dir, "throughput-stream", _hourly)
    return throughput.read_latest(spark, f"{base}/out", ["trial_no"]), counts


def _ntz(ticks):
    return ticks.withColumn("tick_start", F.col("tick_start").cast("timestamp_ntz"))


@query(f"""
    SELECT trial_no, tick_start, docs, tokens, errors, docs_s, toks_s, total_docs FROM ({TICKS_SQL}) WHERE docs > 0""")
def throughput_stream(spark, sf_dir):
    base = scratch_path(spark, "throughput-stream")
    requests = log(spark, sf_dir).select("trial_no", "done_at", "latency_ms", "docs", "tokens", "error")
    requests.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(requests.schema).parquet(f"{base}/in")
    throughput.finish(_hourly(stream, f"{base}/out", f"{base}/checkpoint"))
    ticks = throughput.read_latest(spark, f"{base}/out", ["trial_no"])
    shown = throughput.with_rates(ticks, 3600, ["trial_no"]).drop("latency")
    return _ntz(shown).withColumns({"docs_s": F.round("docs_s", 6), "toks_s": F.round("toks_s", 6)})


def _within(requests, found, keys, error):
    """Per key whether the exact ranks of ``p50_ms`` and ``p95_ms`` are at most ``error`` off."""
    shares = []
    for name, p in throughput.PERCENTILES.items():
        below, upto = F.avg((F.col("latency_ms") < F.col(name)).cast("int")), F.avg((F.col("latency_ms") <= F.col(name)).cast("int"))
        shares.append(((below - error <= p) & (upto + error >= p)).alias(name.replace("_ms", "_within")))
    return requests.join(found.select(*keys, *throughput.PERCENTILES), keys).groupBy(*keys).agg(*shares)


@query(f"""
    SELECT trial_no, tick_start, docs, tokens, errors, true AS p50_within, true AS p95_within FROM ({TICKS_SQL}) WHERE docs > 0""")
def latency_at_stream_ticks(spark, sf_dir):
    """Ticks of a stream that was stopped twice, and whether their latencies have the right ranks; late copies of old requests change nothing."""
    ticks, _ = _stopped_twice(spark, sf_dir)
    shown = throughput.with_latency(ticks)
    requests = log(spark, sf_dir).withColumn("tick_start", F.date_trunc("hour", "done_at"))
    judged = _within(requests, shown, ["trial_no", "tick_start"], 0.01)
    return _ntz(shown.select("trial_no", "tick_start", "docs", "tokens", "errors").join(judged, ["trial_no", "tick_start"]))


@query(f"SELECT trial_no, count(*) AS n, true AS p50_within, true AS p95_within FROM ({LOG_SQL}) GROUP BY ALL")
def latency_of_stream(spark, sf_dir):
    """Latencies of whole runs, from the sketches of their ticks."""
    ticks, _ = _stopped_twice(spark, sf_dir)
    found = throughput.latency_so_far(ticks, ["trial_no"])
    return found.select("trial_no", "n").join(_within(log(spark, sf_dir), found, ["trial_no"], 0.01), "trial_no")


@query(f"""
    SELECT CAST(count(*) + count(DISTINCT trial_no) AS BIGINT) AS rows, count(DISTINCT trial_no) AS late, CAST(3 AS BIGINT) AS batches
    FROM ({LOG_SQL})""")
def late_requests(spark, sf_dir):
    """What a stream counted: rows read, rows dropped as late, micro-batches with rows."""
    _, counts = _stopped_twice(spark, sf_dir)
    total = {name: sum(c[name] for c in counts) for name in ("rows", "late", "batches")}
    return spark.range(1).select(*[F.lit(total[name]).cast("bigint").alias(name) for name in total])


def _write_parts(spark, sf_dir, parts, folder):
    """The documents as JSONL files ``folder/part/file``, a part for each remainder of ``doc_id``; how many files each part has.

    All parts have as many files as the largest one needs for files of about ``FILE_BYTES``, so no task handles a whole part.
    A blank line, which is no record, stands in each file, so that none is left out however the rows fall.
    """
    line = F.to_json(F.struct(F.col("doc_id").alias("_id"), "text"))
    docs = table(spark, sf_dir, "documents").withColumn("part", F.col("doc_id") % parts)
    # Besides its text a line has an id, names and marks.
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 32)
    sizes = docs.groupBy("part").agg(size.alias("bytes")).collect()
    files = max([1, *(-(-row["bytes"] // FILE_BYTES) for row in sizes)])
    lines = docs.select(line.alias("value"), "part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files)).alias("file"))
    held = spark.createDataFrame([(row["part"],) for row in sizes], docs.select("part").schema)
    blank = held.select(F.lit("").alias("value"), "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(files - 1).cast("long"))).alias("file"))
    # One file a task; remainders of negative ids, and a null one, share tasks with others.
    task = F.pmod(F.coalesce("part", F.lit(0)), F.lit(parts)) * files + F.col("file")
    lines.union(blank).repartitionById(parts * files, task.cast("int")).write.partitionBy("part", "file").text(folder)
    return files


@query("SELECT count(DISTINCT doc_id % 6) AS batches, count(*) AS rows FROM documents")
def files_per_trigger(spark, sf_dir):
    """A stream that takes so many files at a time as a part has: its micro-batches, by the commits in its checkpoint."""
    base = scratch_path(spark, "trickle")
    files = _write_parts(spark, sf_dir, 6, f"{base}/in")
    stream = records.record_stream(spark, f"{base}/in/*/*", max_files=files)
    throughput.finish(records.embed_stream(stream, f"{base}/out", f"{base}/checkpoint", Hashing, clean=False))
    commits = spark.read.format("binaryFile").load(f"{base}/checkpoint/commits").where(F.col("path").rlike("/[0-9]+$"))
    batches = commits.agg(F.count("*").alias("batches"))
    return batches.join(F.broadcast(table(spark, sf_dir, "documents").agg(F.count("*").alias("rows"))))


@query(f"""
    SELECT trial_no, tick_start, samples, p50_ms, p95_ms FROM ({ROLLING_TICKS_SQL})
    WHERE tick_start + INTERVAL 1 DAY <= (SELECT time_bucket(INTERVAL 1 MILLISECOND, max(done_at)) - INTERVAL 1 HOUR FROM ({LOG_SQL}))""")
def rolling_stream(spark, sf_dir):
    """The last 2,000 requests at the ends of days, from a stream that was stopped twice; the last, open days are not due yet."""

    def start(stream, output, checkpoint):
        ticks = rolling.rolling_stream(stream, 86_400, late_by="1 hour", keys=["trial_no"])
        return rolling.write_ticks(ticks, output, checkpoint)

    base, _ = _run_in_phases(spark, sf_dir, "rolling-stream", start)
    ticks = rolling.read_ticks(spark, f"{base}/out")
    return _ntz(ticks).withColumns({"p50_ms": F.round("p50_ms", 6), "p95_ms": F.round("p95_ms", 6)})


def _once(spark, sf_dir):
    """Labelled documents in a table; all documents, and every second one again, in a stream.

    Its first start fails for some texts, the second takes them up.
    """
    base = scratch_path(spark, "embed-once")
    docs = documents(spark, sf_dir)
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    write_embeddings(embed_records(prepare_texts(docs.join(labelled, "id", "left_semi")), Hashing), f"{base}/before")
    line = F.to_json(F.struct(F.col("id").alias("_id"), "text"))
    docs.select(line.alias("value")).write.text(f"{base}/in")
    docs.where("id % 2 = 0").select(line.alias("value")).write.mode("append").text(f"{base}/in")
    done = read_embeddings(spark, f"{base}/before")
    for provider in (SomeTextsFail, Hashing):
        stream = records.record_stream(spark, f"{base}/in", max_files=100)
        started = resume.embed_once(
            stream, f"{base}/out", f"{base}/retry", f"{base}/checkpoint", provider, done, batch_size=1, retry_wait=0.0
        )
        throughput.finish(started)
    return base


@query(f"SELECT id, {rendered_sql('embedding')} AS vector FROM ({hashed_sql(CLEAN_DOCUMENTS_SQL, DIMS)})")
def embed_stream_once(spark, sf_dir):
    """Every id once, from the table and the stream together."""
    base = _once(spark, sf_dir)
    embedded = read_embeddings(spark, f"{base}/before").unionByName(read_embeddings(spark, f"{base}/out"))
    return embedded.select("id", rendered(F.col("embedding")).alias("vector"))


@query(f"""
    SELECT id, CAST(2 AS BIGINT) AS tried FROM ({CLEAN_DOCUMENTS_SQL})
    WHERE {FAILS_SQL} >= 3 AND CAST(id AS BIGINT) NOT IN (SELECT doc_id FROM labels)""")
def retried_records(spark, sf_dir):
    """The ids that failed first and were embedded by the next start of the stream."""
    base = _once(spark, sf_dir)
    tries = spark.read.schema(EMBEDDED_TABLE_SCHEMA).parquet(f"{base}/out").groupBy("id").agg(
        F.count("*").alias("tried"), F.max((F.col("status") == "ok").cast("int")).alias("ok")
    )
    return tries.where("tried > 1 AND ok = 1").select("id", "tried")


@query(f"SELECT count(*) AS processed, true AS every_batch_told, true AS rates_hold FROM ({CLEAN_DOCUMENTS_SQL})")
def stream_progress(spark, sf_dir):
    """What a running stream told a listener, added up, beside what it wrote."""
    base = scratch_path(spark, "progress")
    files = _write_parts(spark, sf_dir, 4, f"{base}/in")
    told = progress.Progress()
    spark.streams.addListener(told)
    try:
        stream = records.record_stream(spark, f"{base}/in/*/*", max_files=files)
        running = records.embed_stream(stream, f"{base}/out", f"{base}/checkpoint", Hashing)
        running.awaitTermination()
        progress.await_news(told, running)
    finally:
        spark.streams.removeListener(told)
    told.save(spark, f"{base}/progress")
    rates = progress.progress_rates(spark.read.schema(progress.PROGRESS_SCHEMA).parquet(f"{base}/progress"))
    last = rates.agg(
        F.sum("ok").alias("processed"),
        (F.count_if(F.col("rows") > 0) == 4).alias("every_batch_told"),
        (F.bool_and((F.col("docs_s") >= 0) & (F.col("avg_docs_s") >= 0)) & (F.max("processed") == F.sum("ok"))).alias("rates_hold"),
    )
    written = read_embeddings(spark, f"{base}/out").agg(F.count("*").alias("written"))
    return last.join(F.broadcast(written), F.col("processed") == F.col("written")).drop("written")
