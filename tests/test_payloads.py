from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from loomvec.sources import payloads as pl


def vectors(spark, n=500, parts=3):
    return spark.range(0, n, 1, parts).select(
        F.concat(F.lit("é"), F.col("id")).alias("id"), F.transform(F.sequence(F.lit(1), F.col("id") % 7), lambda x: (x / 3).cast("float")).alias("embedding")
    )


@pytest.mark.parametrize("most_bytes, most_points", [(400, 1000), (100_000, 7), (100_000, 1000)])
def test_files_hold_all_points_within_the_bounds(spark, tmp_path, most_bytes, most_points):
    rows, path = vectors(spark), str(tmp_path / "out")
    pl.write_payloads(pl.payloads(rows, most_bytes, most_points), path)
    back = pl.read_payloads(spark, path)
    assert back.select("id", "embedding").exceptAll(rows).count() == 0 and back.count() == 500
    files = [f for f in glob.glob(f"{path}/*.txt") if os.path.getsize(f)]
    assert max(map(os.path.getsize, files)) <= most_bytes
    assert back.groupBy("file_path").count().agg(F.max("count")).first()[0] <= most_points
    assert back.select("file_path").distinct().count() == len(files)
    # Greedy: of two payloads that follow each other in a task, the first had no room left.
    assert len(files) <= 3 + 2 * max(sum(map(os.path.getsize, files)) / most_bytes, 500 / most_points)


def test_a_point_above_the_bound_is_an_error(spark):
    with pytest.raises(Exception, match="the point 'é6' takes"):
        pl.payloads(vectors(spark, 7, 1), most_bytes=87).collect()


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    rows, path = vectors(spark), str(tmp_path / "out")
    bad = F.when(F.col("id") == "é400", F.raise_error(F.lit("broken")).cast("array<float>")).otherwise(F.col("embedding"))
    with pytest.raises(Exception, match="broken"):
        pl.write_payloads(pl.payloads(rows.withColumn("embedding", bad), 400), path)
    assert glob.glob(f"{path}/**/*.txt", recursive=True) == []


def test_nothing_to_upload(spark, tmp_path):
    pl.write_payloads(pl.payloads(vectors(spark).limit(0)), str(tmp_path / "out"))
    assert pl.read_payloads(spark, str(tmp_path / "out")).count() == 0


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    schema = "id string, embedding array<float>"
    for first in (0, 200):
        rows = vectors(spark).where(F.expr(f"int(substring(id, 2, 9)) >= {first} AND int(substring(id, 2, 9)) < {first + 200}"))
        rows.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        pl.payload_stream(pl.payloads(stream, 400), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    back = pl.read_payloads(spark, str(tmp_path / "out"))
    assert back.count() == back.select("id").distinct().count() == 400
    assert back.agg(F.max("length")).first()[0] <= 400
