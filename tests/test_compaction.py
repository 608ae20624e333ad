from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomvec.operators import compaction, verify
from loomvec.sources import shards

VECTOR = pa.list_(pa.float32())


def write_shard(path, ids, id_name="id", extra=False, vector=VECTOR):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    columns = {
        id_name: pa.array(ids, pa.string()),
        "embedding": pa.array([[float(len(i)), 1.0] for i in ids], vector),
    }
    if extra:
        columns["note"] = pa.array(ids, pa.string())
    pq.write_table(pa.table(columns), path, compression="zstd")


@pytest.fixture
def folders(tmp_path):
    a, b = str(tmp_path / "a dir"), str(tmp_path / "b[1]")
    for i in range(7):
        write_shard(f"{a}/part-{i}.parquet", [f"a{i}-{j}" for j in range(5)])
    for i in range(3):
        write_shard(f"{b}/part-{i}.parquet", [f"b{i}-{j}" for j in range(4)], id_name="_id")
    write_shard(f"{a}/empty.parquet", [])
    write_shard(f"{a}/extra.parquet", ["extra"], extra=True)
    write_shard(f"{b}/doubles.parquet", ["doubles"], vector=pa.list_(pa.float64()))
    write_shard(f"{a}/nested/part-0.parquet", ["nested"])
    with open(f"{a}/part-0.parquet", "rb") as whole, open(f"{a}/cut.parquet", "wb") as cut:
        cut.write(whole.read()[:200])
    with open(f"{a}/notes.txt", "w") as other:
        other.write("not a shard")
    return [a, shards.escape_glob(b)]


GOOD_ROWS = 7 * 5 + 3 * 4


def test_listing_and_inspection(spark, folders):
    listing = shards.list_shards(spark, *folders)
    assert listing.count() == 14
    found = {os.path.basename(row.path): row for row in shards.inspect_shards(listing).collect()}
    assert not found["cut.parquet"].readable and found["cut.parquet"].error
    assert found["extra.parquet"].readable and not found["extra.parquet"].conforms
    assert not found["doubles.parquet"].conforms
    assert found["empty.parquet"].conforms and found["empty.parquet"].rows == 0
    per_dir = {row.dir.rsplit("/", 1)[-1]: row.files for row in shards.files_per_dir(listing).collect()}
    assert per_dir == {"a dir": 10, "b[1]": 4}
    loose = shards.inspect_shards(listing, ignore_extra=True).where("conforms").count()
    assert loose == 12


@pytest.mark.parametrize("layout", ["packed", "chunks"])
def test_compaction_keeps_the_rows_and_reports_the_rest(spark, folders, tmp_path, layout):
    output = str(tmp_path / "out")
    done = compaction.compact(spark, folders, output, files_per_chunk=4, chunks_per_wave=2, layout=layout)
    assert (done.files, done.chunks, done.waves) == (11, 3, 2)
    assert done.rows_expected == done.rows_written == GOOD_ROWS
    rejected = {os.path.basename(row.path) for row in done.rejects.collect()}
    assert rejected == {"cut.parquet", "extra.parquet", "doubles.parquet"}
    table = compaction.read_consolidated(spark, output)
    assert table.columns == ["id", "embedding"]
    ids = sorted(row.id for row in table.collect())
    assert ids == sorted([f"a{i}-{j}" for i in range(7) for j in range(5)] + [f"b{i}-{j}" for i in range(3) for j in range(4)])
    good = [row.path for row in compaction.read_manifest(spark, output).collect()]
    source = shards.read_shards(spark, *map(shards.escape_glob, good))
    assert verify.reconcile(source, table).first().asDict() == {
        "source_rows": GOOD_ROWS, "output_rows": GOOD_ROWS, "same_ids": True, "same_rows": True,
    }
    assert verify.count_differences(source, table).count() == 0


def test_packed_output_is_few_zstd_files(spark, folders, tmp_path):
    output = str(tmp_path / "out")
    compaction.compact(spark, folders, output)
    files = [f for f in os.listdir(f"{output}/wave=00000") if f.endswith(".parquet")]
    assert len(files) == 1 and files[0].endswith(".zstd.parquet")


def test_large_chunks_are_split(spark, folders, tmp_path):
    output = str(tmp_path / "out")
    compaction.compact(spark, folders, output, files_per_chunk=100, layout="chunks", target_bytes=1000)
    files = [f for f in os.listdir(f"{output}/wave=00000/chunk=0") if f.endswith(".parquet")]
    assert len(files) > 1
    assert compaction.read_consolidated(spark, output).count() == GOOD_ROWS


def test_running_again_takes_new_files_only(spark, folders, tmp_path):
    output = str(tmp_path / "out")
    compaction.compact(spark, folders, output, files_per_chunk=4)
    assert compaction.compact(spark, folders, output, files_per_chunk=4).files == 0
    write_shard(f"{folders[0]}/a-new.parquet", ["new"])
    again = compaction.compact(spark, folders, output, files_per_chunk=4)
    assert (again.files, again.rows_written) == (1, 1)
    assert compaction.read_consolidated(spark, output).count() == GOOD_ROWS + 1
    chunks = compaction.read_manifest(spark, output).agg(F.max("chunk"), F.countDistinct("path")).first()
    assert tuple(chunks) == (3, 12)


def test_a_wave_cut_off_is_not_read_and_is_written_over(spark, folders, tmp_path):
    output = str(tmp_path / "out")
    write_shard(f"{output}/wave=00000/part-cut-off.parquet", ["half"])
    assert compaction.read_consolidated(spark, output).count() == 0
    compaction.compact(spark, folders, output)
    assert compaction.read_consolidated(spark, output).where("id = 'half'").count() == 0


def test_nothing_to_do(spark, tmp_path):
    empty = tmp_path / "none"
    empty.mkdir()
    done = compaction.compact(spark, [str(empty)], str(tmp_path / "out"))
    assert (done.files, done.chunks, done.rows_written) == (0, 0, 0)


def test_plan_follows_the_path_order(spark, folders):
    files = shards.list_shards(spark, *folders)
    plan = compaction.plan_compaction(files, files_per_chunk=4, first_chunk=10).orderBy("path").collect()
    assert [row.chunk for row in plan] == [10 + i // 4 for i in range(14)]


def test_chunks_by_bytes(spark):
    sizes = [10, 0, 90, 500, 0, 1, 99, 100, 100, 30, 30, 30, 30, 0]
    files = spark.createDataFrame([(f"p{i:02}", n) for i, n in enumerate(sizes)], "path string, length long").repartition(3)
    plan = sorted((r.path, r.chunk) for r in compaction.plan_compaction(files, chunk_bytes=100, first_chunk=5).collect())
    chunks = [chunk for _, chunk in plan]
    assert chunks == sorted(chunks) and sorted(set(chunks)) == list(range(5, 5 + len(set(chunks))))
    for chunk in set(chunks):
        held = [n for n, c in zip(sizes, chunks) if c == chunk]
        assert sum(held) < 100 + max(held)
    assert compaction.plan_compaction(files.limit(0), chunk_bytes=100).count() == 0


def test_shards_read_as_a_bag(spark, folders):
    a = folders[0]
    twice = shards.read_shards(spark, a, a, skip_bad=True)
    assert twice.count() == len(twice.collect()) == 2 * 35
    with pytest.raises(Exception, match="cut.parquet"):
        shards.read_shards(spark, a).collect()


@pytest.mark.parametrize(
    ("vector", "good"),
    [
        (pa.list_(pa.float32()), True),
        (pa.list_(pa.float32(), 2), True),
        (pa.large_list(pa.float32()), True),
        (pa.list_(pa.float64()), False),
    ],
)
def test_lists_of_32_bit_floats_are_shards(spark, tmp_path, vector, good):
    write_shard(f"{tmp_path}/in/part-0.parquet", ["a", "bb"], vector=vector)
    read = shards.read_shards(spark, f"{tmp_path}/in", skip_bad=True)
    assert read.count() == len(read.collect()) == (2 if good else 0)


@pytest.mark.parametrize("whole_bytes, files_per_wave", [(1 << 20, 4), (0, 100), (600, 5)])
def test_small_and_large_files_are_inspected_alike(spark, folders, whole_bytes, files_per_wave):
    listing = shards.list_shards(spark, *folders)
    facts = ["path", "file_path", "dir", "length", "readable", "rows", "conforms"]
    want = shards.inspect_shards(listing)
    found = shards.inspect_shards(listing, whole_bytes=whole_bytes, files_per_wave=files_per_wave)
    assert found.count() == want.count() == 14
    assert found.select(facts).exceptAll(want.select(facts)).count() == 0
    assert found.where("NOT readable AND error IS NULL").count() == 0
    named = {row.columns for row in found.where("conforms").select("columns").collect()}
    assert all("embedding: list<element: float>" in columns or "embedding: list<item: float>" in columns for columns in named)


@pytest.fixture
def behind_spark(spark, tmp_path):
    """A path that only a file system of Spark's own configuration leads to."""
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("fs.viewfs.mounttable.depot.link./data", f"file://{tmp_path}")
    return "viewfs://depot/data"


def test_paths_that_only_spark_opens(spark, folders, behind_spark):
    where = [f"{behind_spark}/a dir", f"{behind_spark}/b?1?"]
    report = verify.file_report(spark, *where)
    assert report.count() == 14 and report.where("NOT readable").count() == 1
    assert all(row.path.startswith("viewfs://depot/data/") for row in report.collect())
    sound = shards.read_shards(spark, *where, skip_bad=True)
    done = compaction.compact(spark, where, f"{behind_spark}/out", files_per_chunk=4)
    assert done.rows_written == sound.count() == GOOD_ROWS
    assert compaction.compact(spark, where, f"{behind_spark}/out").files == 0
    assert verify.reconcile(sound, compaction.read_consolidated(spark, f"{behind_spark}/out")).first().same_rows


def test_changed_vectors_do_not_reconcile(spark):
    left = spark.createDataFrame([("a", [1.0])], "id string, embedding array<float>")
    right = spark.createDataFrame([("a", [2.0])], "id string, embedding array<float>")
    report = verify.reconcile(left, right).first()
    assert report.same_ids and not report.same_rows


def test_nothing_readable_is_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.parquet").write_text("not Parquet at all")
    with pytest.raises(ValueError, match="none of the files"):
        compaction.compact(spark, [str(tmp_path / "in")], str(tmp_path / "out"))


def test_differences_by_id(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    right = spark.createDataFrame([("a",), ("c",), (None,)], "id string")
    found = {tuple(row) for row in verify.count_differences(left, right).collect()}
    assert found == {("a", 2, 1), ("b", 1, 0), ("c", 0, 1)}
    report = verify.reconcile(left, right).first()
    assert (report.source_rows, report.output_rows, report.same_ids) == (4, 3, False)


def test_file_report(spark, folders):
    report = {os.path.basename(row.path): row for row in verify.file_report(spark, *folders).collect()}
    assert report["part-1.parquet"].rows in (4, 5)
    assert "embedding: list" in report["part-1.parquet"].columns
    assert report["cut.parquet"].readable is False


@pytest.mark.parametrize("layout", ["packed", "chunks"])
def test_a_file_with_damaged_pages_is_left_out_whole(spark, tmp_path, layout):
    folder, output = tmp_path / "in", str(tmp_path / "out")
    for name in ("good", "bad"):
        write_shard(f"{folder}/{name}.parquet", [f"{name}-{i}-{hash((name, i))}" for i in range(20_000)])
    data = bytearray((folder / "bad.parquet").read_bytes())
    data[len(data) // 3 : len(data) // 3 + 2000] = os.urandom(2000)
    (folder / "bad.parquet").write_bytes(data)
    done = compaction.compact(spark, [str(folder)], output, layout=layout)
    assert done.rows_written == 20_000
    rejected = done.rejects.collect()
    assert [(os.path.basename(row.path), row.error) for row in rejected] == [("bad.parquet", "damaged data pages")]
    table = compaction.read_consolidated(spark, output)
    assert table.count() == 20_000 and table.where("id LIKE 'bad%'").count() == 0
    read = shards.read_shards(spark, str(folder), skip_bad=True)
    assert len(read.collect()) == read.count() == 20_000
    rejected = shards.rejected_shards(spark, str(folder)).collect()
    assert [(os.path.basename(row.path), row.error) for row in rejected] == [("bad.parquet", shards.DAMAGED)]
    write_shard(f"{folder}/bad.parquet", ["bad-mended"])
    assert compaction.compact(spark, [str(folder)], output, layout=layout).rows_written == 1
