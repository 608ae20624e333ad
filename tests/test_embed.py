from __future__ import annotations

import os
import subprocess
import sys
import time
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomvec.operators import providers
from loomvec.operators.embed import Packing, _packed, _rebatch, dead_letter, embed_records, embedded_ok
from loomvec.operators.providers import HashingProvider, HttpProvider
from loomvec.operators.resume import resume_pending
from loomvec.session import scratch_path
from loomvec.operators.request_log import most_open, trial_metrics
from loomvec.sources.shards import read_dead_letter, read_embeddings, read_request_log, write_embeddings


def texts(spark, n=100, partitions=3):
    text = F.concat(F.lit("word"), F.col("id") % 17, F.lit(" and "), F.col("id"))
    return spark.range(0, n, 1, partitions).select(F.col("id").cast("string").alias("id"), text.alias("text"))


class Recorder:
    """Answers with one number per text and notes what it was asked."""

    def embed(self, batch, endpoint):
        return [[float(len(text)), float(len(batch))] for text in batch]


class Down:
    def __init__(self, bad="http://down"):
        self.bad = bad

    def embed(self, batch, endpoint):
        if endpoint is None or endpoint.startswith(self.bad):
            raise TimeoutError("no answer")
        return [[1.0] for _ in batch]


class Short:
    def embed(self, batch, endpoint):
        return [[1.0] for _ in batch[1:]]


class Ragged:
    def embed(self, batch, endpoint):
        return [[1.0] * (1 + i % 3) for i, _ in enumerate(batch)]


class Slow:
    def embed(self, batch, endpoint):
        time.sleep(0.2)
        return [[float(text.split(" ")[-1])] for text in batch]


def test_batches_have_the_wanted_size_within_a_task(spark):
    with_sizes = embed_records(texts(spark, 100, 1), Recorder, batch_size=32)
    sizes = [row.embedding[1] for row in with_sizes.orderBy(F.col("id").cast("int")).collect()]
    assert sizes == [32.0] * 96 + [4.0] * 4


def test_every_row_comes_out_once(spark):
    embedded = embed_records(texts(spark), Recorder, batch_size=7, in_flight=3)
    assert embedded.select("id").exceptAll(texts(spark).select("id")).count() == 0
    assert embedded.count() == 100


def test_failed_endpoint_is_retried_on_the_next(spark):
    urls = ["http://down", "http://up"]
    embedded = embed_records(texts(spark), Down, urls, batch_size=10, retry_wait=0).collect()
    assert {row.status for row in embedded} == {"ok"}
    assert {row.endpoint for row in embedded} == {"http://up"}
    assert {row.attempts for row in embedded} == {1, 2}


def test_rows_of_a_failed_batch_are_kept(spark):
    embedded = embed_records(texts(spark), Down, max_attempts=2, retry_wait=0)
    assert embedded_ok(embedded).count() == 0
    failed = dead_letter(embedded).collect()
    assert len(failed) == 100
    assert {(row.error, row.attempts) for row in failed} == {("TimeoutError: no answer", 2)}


def test_no_wait_after_the_last_attempt(spark):
    started = time.time()
    embed_records(texts(spark, 5, 1), Down, max_attempts=1, retry_wait=60).collect()
    assert time.time() - started < 30


def test_answer_out_of_line_is_not_used(spark):
    failed = dead_letter(embed_records(texts(spark, 10, 1), Short, batch_size=5)).collect()
    assert {row.error for row in failed} == {"bad response: 4 vectors for 5 texts"}


def test_ragged_vectors_are_accepted(spark):
    rows = embed_records(texts(spark, 9, 1), Ragged).select(F.size("embedding").alias("n")).collect()
    assert sorted(row.n for row in rows) == [1] * 3 + [2] * 3 + [3] * 3


def test_requests_overlap_and_stay_in_order(spark):
    started = time.time()
    rows = embed_records(texts(spark, 40, 1), Slow, batch_size=1, in_flight=10).collect()
    assert time.time() - started < 6
    assert [row.id for row in rows] == [str(i) for i in range(40)]
    assert all(row.embedding == [float(row.id)] for row in rows)


def test_normalize(spark):
    rows = embed_records(texts(spark), Recorder, normalize=True).collect()
    assert all(np.linalg.norm(row.embedding) == pytest.approx(1, abs=1e-6) for row in rows)


def test_write_once_then_resume(spark):
    path = scratch_path(spark, "embedded")
    half = texts(spark).where("id < 50")
    counts = write_embeddings(embed_records(half, HashingProvider), path)
    assert counts == {"ok": 50, "failed": 0}
    counts = write_embeddings(embed_records(texts(spark).where("id >= 90"), Down, retry_wait=0), path)
    assert counts == {"ok": 0, "failed": 10}
    pending = resume_pending(texts(spark), read_embeddings(spark, path))
    assert pending.count() == 50
    assert read_dead_letter(spark, path).count() == 10
    write_embeddings(embed_records(pending, HashingProvider), path)
    assert read_embeddings(spark, path).select("id").distinct().count() == 100
    assert resume_pending(texts(spark), read_embeddings(spark, path)).count() == 0


def test_resume_with_one_id_in_a_third_of_the_rows(spark):
    copies = texts(spark).unionByName(spark.range(50).select(F.lit("7").alias("id"), F.lit("t").alias("text")))
    done = spark.range(40).select(F.when(F.col("id") < 30, "7").otherwise("8").alias("id"))
    pending = resume_pending(copies, done)
    assert pending.count() == 98
    assert pending.where("id IN ('7', '8')").count() == 0


def test_hashing_provider():
    provider = HashingProvider(64)
    vectors = provider.embed(["a b a", "", "a", "a  b "])
    assert vectors.shape == (4, 64)
    assert np.allclose(np.linalg.norm(vectors[[0, 2, 3]], axis=1), 1)
    assert not vectors[1].any()
    assert np.abs(vectors[2]).max() == pytest.approx(1)
    assert np.allclose(vectors, HashingProvider(64).embed(["a b a", "", "a", "b a"]))
    assert provider.embed([]).shape == (0, 64)


def test_http_provider_bodies_and_answers():
    sent = []

    def post(answer, url, body, headers, timeout):
        sent.append((url, body, headers, timeout))
        return answer

    bare = HttpProvider(post=partial(post, [[1.0, 2.0], [3.0, 4.0]]))
    assert bare.embed(["a", "b"], "http://x") == [[1.0, 2.0], [3.0, 4.0]]
    nested = HttpProvider(post=partial(post, [[[1.0, 2.0]]]))
    assert nested.embed(["a"], "http://x") == [[1.0, 2.0]]
    keyed = HttpProvider(providers.text_payload, "tok", 60.0, partial(post, {"embeddings": [[1.0, 2.0]]}))
    assert keyed.embed(["a"], "http://y") == [[1.0, 2.0]]
    assert sent[0] == ("http://x", {"inputs": ["a", "b"], "truncate": True}, {}, 120.0)
    assert sent[2] == ("http://y", {"text": ["a"]}, {"Authorization": "Bearer tok"}, 60.0)


@pytest.mark.parametrize(
    "answer", [[[1.0], [[2.0]]], [[[[1.0]]]], [[[1.0], [2.0]]], {"error": "busy"}, None, [1.0]]
)
def test_mixed_or_deeper_answers_are_bad(answer):
    with pytest.raises(ValueError):
        providers.parse_vectors(answer)


def test_one_dimension_is_not_unwrapped():
    assert providers.parse_vectors([[1.0], [2.0]]) == [[1.0], [2.0]]
    assert providers.parse_vectors([]) == []


def test_dead_letter_keeps_what_still_fails(spark):
    path = scratch_path(spark, "embedded")
    some = texts(spark, 20)
    for tries in (1, 2):
        write_embeddings(embed_records(some, Down, max_attempts=tries, retry_wait=0), path)
    failed = read_dead_letter(spark, path).collect()
    assert len(failed) == 20 and {row.attempts for row in failed} == {2}
    write_embeddings(embed_records(some.where("id < 15"), HashingProvider), path)
    assert sorted(int(row.id) for row in read_dead_letter(spark, path).collect()) == [15, 16, 17, 18, 19]


def test_every_try_is_logged(spark):
    path = scratch_path(spark, "logged")
    urls = ["http://down", "http://up"]
    write_embeddings(embed_records(texts(spark), Down, urls, batch_size=10, retry_wait=0, log_requests=True), path)
    log = read_request_log(spark, path, batch=10, conc=1)
    table = log.toPandas()
    assert table["request_id"].is_unique and (table["latency_ms"] >= 0).all()
    good = table[table["error"] == 0]
    assert good["docs"].sum() == 100 and good["tokens"].sum() == 300
    assert (table["error"] == 1).any()
    trial = trial_metrics(log).first()
    assert (trial.batch, trial.errors) == (10, int((table["error"] == 1).sum()))
    assert read_embeddings(spark, path).count() == 100


def test_cleaning_and_embedding_need_no_shuffle(spark):
    from loomvec.operators.embed import prepare_texts

    plan = embed_records(prepare_texts(texts(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def arrow_batches(lengths, size=7):
    rows = [(str(i), " ".join(["w"] * n)) for i, n in enumerate(lengths)]
    for at in range(0, len(rows), size):
        ids, texts = zip(*rows[at : at + size])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts)], names=["id", "text"])


@pytest.mark.parametrize("buffer_rows", [1, 2, 10, 64, 5000])
@pytest.mark.parametrize("budget", [1, 30, 500])
def test_packing_sends_every_row_once_within_the_budget(buffer_rows, budget):
    lengths = [(i * 7919) % 60 for i in range(500)] + [3000, 0, 0]
    packing = Packing(padded_tokens=budget, buffer_rows=buffer_rows)
    batches = list(_packed(arrow_batches(lengths), 16, packing))
    assert sorted(int(i) for ids, _ in batches for i in ids) == list(range(len(lengths)))
    for ids, found in batches:
        assert len(ids) == len(found) <= 16
        assert all(len(text.split()) == lengths[int(i)] for i, text in zip(ids, found))
        longest = max(min(2048, len(text.split())) for text in found)
        assert len(ids) == 1 or len(ids) * longest <= budget
    # A task holds no more than its buffer before a batch goes out.
    taken = 0

    def counted():
        nonlocal taken
        for batch in arrow_batches(lengths, 1):
            taken += 1
            yield batch

    sent = 0
    for ids, _ in _packed(counted(), 16, packing):
        assert taken - sent <= buffer_rows
        sent += len(ids)


def test_packed_batches_need_less_padding():
    lengths = [(i * 7919) % 200 for i in range(4000)]
    padded = lambda batches: sum(len(texts) * max(len(t.split()) for t in texts) for _, texts in batches)
    plain = padded(_rebatch(arrow_batches(lengths), 32))
    packed = padded(_packed(arrow_batches(lengths), 32, Packing(buffer_rows=1000)))
    assert sum(lengths) <= packed < 1.1 * sum(lengths) < 0.7 * plain


def test_packing_of_no_rows():
    assert list(_packed(iter(()), 4, Packing())) == []


class Slow:
    def embed(self, batch, endpoint):
        time.sleep(0.01)
        return [[1.0]] * len(batch)


@pytest.mark.parametrize("bound, in_flight", [(1, 1), (2, 1), (4, 2), (7, 3)])
def test_open_requests_of_all_tasks_stay_within_the_bound(spark, tmp_path, bound, in_flight):
    rows = texts(spark, 400, 12)
    embedded = embed_records(rows, Slow, batch_size=5, in_flight=in_flight, open_requests=bound, log_requests=True)
    write_embeddings(embedded, str(tmp_path))
    log = read_request_log(spark, str(tmp_path), 5, in_flight)
    assert log.agg(F.sum("docs")).first()[0] == 400
    most = most_open(log).first().most_open
    assert 1 <= most <= bound
    if bound == 4:
        free = embed_records(rows, Slow, batch_size=5, in_flight=3, log_requests=True)
        write_embeddings(free, str(tmp_path / "free"))
        assert most_open(read_request_log(spark, str(tmp_path / "free"), 5, 3)).first().most_open > 4


def test_a_bound_below_one_task_is_an_error(spark):
    with pytest.raises(ValueError):
        embed_records(texts(spark), Slow, in_flight=4, open_requests=3)


CLUSTER = """
import sys
sys.path.insert(0, {root!r})
import time
from pyspark import cloudpickle
from loomvec.session import build_session
from loomvec.operators.embed import embed_records
from loomvec.operators.request_log import most_open
from loomvec.sources.shards import read_request_log, write_embeddings
from pyspark.sql import functions as F
class Slow:
    def embed(self, batch, endpoint):
        time.sleep(0.02)
        return [[1.0]] * len(batch)
spark = build_session("slots", master="local-cluster[2,2,1024]", **{{
    "spark.executor.instances": "2", "spark.executor.cores": "2", "spark.executor.memory": "900m", "spark.ui.enabled": "false",
    "spark.checkpoint.dir": {folder!r}, "spark.driver.host": "127.0.0.1"}})
rows = spark.range(0, 240, 1, 12).select(F.col("id").cast("string").alias("id"), F.lit("text").alias("text"))
for name, bound in (("free", None), ("bound", 2)):
    out = {folder!r} + "/" + name
    write_embeddings(embed_records(rows, Slow, batch_size=4, open_requests=bound, log_requests=True), out)
    log = read_request_log(spark, out, 4, 1)
    print(name, log.agg(F.sum("docs")).first()[0], most_open(log).first().most_open, log.rdd.getNumPartitions() > 2)
spark.stop()
"""


def test_tasks_take_more_cores_on_a_cluster_of_known_size(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = CLUSTER.format(root=root, folder=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    (_, rows, free, _), (_, bounded_rows, bound, many) = [line.split() for line in done.stdout.splitlines() if line.startswith(("free", "bound"))]
    assert rows == bounded_rows == "240" and int(bound) <= 2 < int(free)
    assert many == "True"  # the tasks were not put together
