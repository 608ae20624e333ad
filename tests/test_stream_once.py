from __future__ import annotations

import json
from functools import partial

from loomvec.operators.embed import embed_records
from loomvec.operators.providers import HashingProvider
from loomvec.sources.shards import read_dead_letter, read_embeddings, write_embeddings
from loomvec.streaming import records, resume, throughput

Hashing = partial(HashingProvider, 8)


class OddTextsFail:
    def embed(self, texts, endpoint=None):
        if any(int(t.split()[-1]) % 2 for t in texts):
            raise ConnectionError("no answer")
        return Hashing().embed(texts)


def add_file(folder, name, ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"_id": i, "text": f"text number {i}"}) + "\n" for i in ids))


def test_records_without_an_id_all_pass(spark, tmp_path):
    spark.createDataFrame([(None, "text 1"), (None, "text 1"), ("1", "text 1"), ("1", "text 1")], "id string, text string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id string, text string").parquet(f"{tmp_path}/in")
    throughput.finish(resume.embed_once(stream, f"{tmp_path}/out", f"{tmp_path}/retry", f"{tmp_path}/checkpoint", Hashing))
    assert [r.id for r in read_embeddings(spark, f"{tmp_path}/out").orderBy("id").collect()] == [None, None, "1"]


def run(spark, base, provider=Hashing, done=None, **options):
    stream = records.record_stream(spark, str(base / "in"), max_files=1)
    places = (f"{base}/out", f"{base}/retry", f"{base}/checkpoint")
    started = resume.embed_once(stream, *places, provider, done, batch_size=1, retry_wait=0.0, max_attempts=1, **options)
    return throughput.finish(started)


def ids(frame):
    return sorted(int(r.id) for r in frame.select("id").collect())


def test_an_id_in_the_table_and_in_two_files_is_embedded_once(spark, tmp_path):
    done = spark.createDataFrame([(str(i), f"text number {i}") for i in range(10)], "id string, text string")
    write_embeddings(embed_records(done, Hashing), f"{tmp_path}/before")
    before = read_embeddings(spark, f"{tmp_path}/before")
    add_file(tmp_path / "in", "1.jsonl", [5, 12, 12, *range(20, 30)])
    assert run(spark, tmp_path, done=before)["rows"] == 13
    add_file(tmp_path / "in", "2.jsonl", [5, 12, *range(25, 35)])
    assert run(spark, tmp_path, done=before)["rows"] == 12
    assert run(spark, tmp_path, done=before)["rows"] == 0
    assert ids(read_embeddings(spark, f"{tmp_path}/out")) == [12, *range(20, 35)]


def test_failed_ids_come_back_until_they_are_embedded(spark, tmp_path):
    add_file(tmp_path / "in", "1.jsonl", range(10))
    run(spark, tmp_path, OddTextsFail)
    out = f"{tmp_path}/out"
    assert ids(read_embeddings(spark, out)) == [0, 2, 4, 6, 8]
    assert ids(read_dead_letter(spark, out)) == [1, 3, 5, 7, 9]
    # Sent again, a failed id is known; it comes back by itself, once.
    add_file(tmp_path / "in", "2.jsonl", [1, 2, 11])
    run(spark, tmp_path, Hashing)
    assert ids(read_embeddings(spark, out)) == [*range(10), 11]
    assert read_dead_letter(spark, out).count() == 0
    run(spark, tmp_path, Hashing)
    assert ids(read_embeddings(spark, out)) == [*range(10), 11]


def test_rounds_are_bounded(spark, tmp_path):
    add_file(tmp_path / "in", "1.jsonl", [1, 2])
    for _ in range(4):
        run(spark, tmp_path, OddTextsFail, max_rounds=2)
    tried = spark.read.parquet(f"{tmp_path}/out").where("id = '1'").count()
    assert tried == 3
    assert ids(read_dead_letter(spark, f"{tmp_path}/out")) == [1]
