from __future__ import annotations

import datetime as dt
import json
from functools import partial

from pyspark.sql import functions as F

from loomvec.operators import request_log
from loomvec.operators.embed import embed_records, embedded_ok, prepare_texts
from loomvec.operators.providers import HashingProvider
from loomvec.plans.catalog import streams
from loomvec.sources.records import read_records
from loomvec.sources.shards import read_embeddings
from loomvec.streaming import records, rolling, throughput

Hashing = partial(HashingProvider, 8)


def add_file(folder, name, start, stop):
    lines = [json.dumps({"_id": i, "text": f"text number {i} #tag"}) for i in range(start, stop)]
    (folder / name).write_text("\n".join([*lines, "not json", '{"_id": 1}']) + "\n")


def run(spark, folder, base):
    stream = records.record_stream(spark, str(folder), max_files=1)
    records.embed_stream(stream, f"{base}/out", f"{base}/checkpoint", Hashing).awaitTermination()
    return read_embeddings(spark, f"{base}/out")


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    add_file(folder, "1.jsonl", 0, 40)
    add_file(folder, "2.jsonl", 40, 60)
    assert run(spark, folder, tmp_path).count() == 60
    assert run(spark, folder, tmp_path).count() == 60
    add_file(folder, "3.jsonl", 60, 75)
    streamed = run(spark, folder, tmp_path)
    batch = embedded_ok(embed_records(prepare_texts(read_records(spark, str(folder))), Hashing))
    assert streamed.count() == 75
    assert streamed.exceptAll(batch).count() == 0


SCHEMA = "done_at timestamp, request_id long, latency_ms double, docs int, tokens bigint, error int, run string"
START = dt.datetime(2024, 1, 1)


def requests(first, last, run="ab", shift=0):
    """Every second a request, of each run in turn; some latencies are missing."""
    return [
        (START + dt.timedelta(seconds=i + shift), i, None if i % 17 == 3 else float(i * 7919 % 1000), 4, 40, int(i % 5 == 0), run[i % len(run)])
        for i in range(first, last)
    ]


def add(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def stream_of(spark, path):
    path.mkdir(exist_ok=True)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_throughput_stream_equals_batch(spark, tmp_path):
    for part in range(3):
        add(spark, requests(part * 20, part * 20 + 30), tmp_path / "in")
    rates = throughput.throughput_stream(stream_of(spark, tmp_path / "in"), "5 seconds", "10 minutes", ["run"])
    for want in (3, 0):
        counts = throughput.finish(throughput.write_updates(rates, str(tmp_path / "out"), str(tmp_path / "ck")))
        assert counts == {"rows": 30 * want, "batches": want, "late": 0}
    found = throughput.read_latest(spark, str(tmp_path / "out"), ["run"])
    whole = spark.read.parquet(str(tmp_path / "in"))
    batch = whole.groupBy(F.window("done_at", "5 seconds").start.alias("tick_start"), "run").agg(
        F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"), F.sum("error").cast("bigint").alias("errors")
    )
    assert found.count() == batch.count()
    assert found.select(batch.columns).exceptAll(batch).count() == 0
    rated = throughput.with_rates(found, 5, ["run"])
    assert rated.agg(F.max("total_docs")).first()[0] == 45 * 4
    want = request_log.interval_rate(whole.withColumn("latency_ms", F.coalesce("latency_ms", F.lit(0.0))), 5, ["run"])
    both = rated.join(want.select("run", "tick_start", F.col("docs_s").alias("want")), ["run", "tick_start"])
    assert both.count() == found.count()
    # Without a latency a request's start is unknown, which can only shorten the first tick.
    assert both.where("abs(docs_s - want) > 1e-9 * want").count() <= 2


def test_latency_sketches_of_ticks_merge_to_those_of_runs(spark, tmp_path):
    for part in range(4):
        add(spark, requests(part * 500, part * 500 + 500), tmp_path / "in")
    rates = throughput.throughput_stream(stream_of(spark, tmp_path / "in"), "1 minute", "1 minute", ["run"], sketch_size=200)
    throughput.finish(throughput.write_updates(rates, str(tmp_path / "out"), str(tmp_path / "ck")))
    ticks = throughput.read_latest(spark, str(tmp_path / "out"), ["run"])
    for found in throughput.latency_so_far(ticks, ["run"]).collect():
        values = sorted(r[2] for r in requests(0, 2000) if r[6] == found.run and r[2] is not None)
        assert found.n == len(values)
        for p, value in ((0.5, found.p50_ms), (0.95, found.p95_ms)):
            assert abs(sum(v <= value for v in values) / len(values) - p) < 0.03
    empty = throughput.with_latency(ticks.where("latency IS NOT NULL").limit(0))
    assert empty.columns[-2:] == ["p50_ms", "p95_ms"]


def test_ticks_without_latencies_show_zero(spark, tmp_path):
    add(spark, [(START, 1, None, 1, 1, 0, "a")], tmp_path / "in")
    rates = throughput.throughput_stream(stream_of(spark, tmp_path / "in"), keys=["run"])
    throughput.finish(throughput.write_updates(rates, str(tmp_path / "out"), str(tmp_path / "ck")))
    row = throughput.with_latency(throughput.read_latest(spark, str(tmp_path / "out"), ["run"])).first()
    assert (row.docs, row.p50_ms, row.p95_ms) == (1, 0.0, 0.0)


def test_late_requests_are_dropped_and_counted(spark, tmp_path):
    rates = throughput.throughput_stream(stream_of(spark, tmp_path / "in"), "5 seconds", "30 seconds", ["run"])
    late = []
    # The third part is within the delay, the last one is not.
    for rows in (requests(0, 60), requests(60, 300), requests(270, 280), requests(0, 10, shift=5)):
        add(spark, rows, tmp_path / "in")
        late.append(throughput.finish(throughput.write_updates(rates, str(tmp_path / "out"), str(tmp_path / "ck")))["late"])
    # Ten late requests are four groups of a window and a run.
    assert late == [0, 0, 0, 4]
    found = throughput.read_latest(spark, str(tmp_path / "out"), ["run"])
    assert found.agg(F.sum("docs")).first()[0] == 4 * 310


def test_rolling_stream_equals_batch_over_restarts(spark, tmp_path):
    rolled = rolling.rolling_stream(stream_of(spark, tmp_path / "in"), 10, "20 seconds", ["run"], rows=25)
    # Parts overlap in time, and requests come out of order within the delay.
    for first in range(0, 400, 100):
        add(spark, [r for i in range(first, first + 100, 10) for r in reversed(requests(i, i + 10, "aab"))], tmp_path / "in")
        if first in (100, 300):
            throughput.finish(rolling.write_ticks(rolled, str(tmp_path / "out"), str(tmp_path / "ck")))
    whole = spark.read.parquet(str(tmp_path / "in")).where("latency_ms IS NOT NULL")
    want = request_log.rolling_latency_at_ticks(whole, 10, ["run"], rows=25).where(F.col("tick_start") + F.expr("INTERVAL 10 SECONDS") <= F.lit(START + dt.timedelta(seconds=379)))
    rounded = [F.round(c, 9).alias(c) for c in ("p50_ms", "p95_ms")]
    got = rolling.read_ticks(spark, str(tmp_path / "out"))
    key = ["run", "tick_start", "samples", *rounded]
    assert got.count() == want.count() > 50
    assert got.select(key).exceptAll(want.select(key)).count() == 0


def test_a_part_of_a_stream_is_many_files(spark, tmp_path, monkeypatch):
    """However large a part is, no file and so no task holds all of it; the micro-batches are still those of the parts."""
    monkeypatch.setattr(streams, "FILE_BYTES", 20_000, raising=False)
    rows = [(4 * i if i < 900 else i, f"text {i} " * 20) for i in range(1200)]
    rows += [(8, "copy " * 30)] * 600 + [(2, None), (3, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    with_text = sum(bool(text) for _, text in rows)
    for name, parts, wanted in (("stream_progress", 4, (with_text, True, True)), ("files_per_trigger", 6, (6, len(rows)))):
        base = tmp_path / name
        monkeypatch.setattr(streams, "scratch_path", lambda spark, name, base=base: str(base))
        assert [tuple(r) for r in getattr(streams, name)(spark, str(tmp_path)).collect()] == [wanted]
        sizes = [p.stat().st_size for p in (base / "in").rglob("part-*")]
        assert len(sizes) % parts == 0 and max(sizes) < 40_000
