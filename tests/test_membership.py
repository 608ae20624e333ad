from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomvec.operators.membership import Limits, without_members
from loomvec.operators.resume import resume_pending


def records(spark, n=20_000):
    rows = spark.range(n).selectExpr("cast(id as string) AS id", "concat('text of ', id) AS text")
    more = spark.createDataFrame([(None, "no id"), (None, "no id"), ("7", "again"), ("8", "again"), ("", "empty")], "id string, text string")
    return rows.unionByName(more)


def members(spark, n=40_000):
    even = spark.range(0, n, 2).selectExpr("cast(id as string) AS id", "1 AS extra")
    return even.unionByName(spark.createDataFrame([(None, 1), ("8", 1)], "id string, extra int"))


def pending(rows):
    return sorted((r.id or "-", r.text) for r in rows.collect())


WHOLE = {
    "roomy": Limits(),
    "few bits": Limits(bits_per_key=1, exact_bytes=0),
    "exact rest": Limits(bits_per_key=1, exact_bytes=100_000),
    "two levels": Limits(bits_per_key=2, exact_bytes=0, levels=2),
    "three levels": Limits(bits_per_key=2, exact_bytes=0, levels=3),
    "saturated": Limits(most_bits=256, exact_bytes=0),
    "saturated, exact": Limits(most_bits=256),
}


@pytest.mark.parametrize("limits", WHOLE.values(), ids=WHOLE)
def test_no_id_is_lost_or_done_twice(spark, limits):
    want = sorted([(str(i), f"text of {i}") for i in range(1, 20_000, 2)] + [("-", "no id")] * 2 + [("7", "again"), ("-", "empty")])
    assert pending(without_members(records(spark), members(spark), "id", limits)) == want


def test_nothing_done_and_nothing_to_do(spark):
    rows = records(spark, 10)
    assert without_members(rows, members(spark).limit(0), "id").count() == rows.count()
    assert without_members(rows.limit(0), members(spark), "id").count() == 0
    assert without_members(rows, rows, "id").where("id IS NOT NULL").count() == 0


def test_other_types_of_key(spark):
    rows, done = spark.range(1000).withColumn("text", F.lit("x")), spark.range(500)
    assert without_members(rows, done, "id", Limits(bits_per_key=1)).count() == 500


@pytest.mark.parametrize("limits", [Limits(), Limits(bits_per_key=1, exact_bytes=100_000)], ids=["roomy", "few bits"])
def test_no_exchange_carries_text(spark, limits, tmp_path):
    records(spark).write.parquet(str(tmp_path / "records"))
    rows = spark.read.parquet(str(tmp_path / "records"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = resume_pending(rows, members(spark), limits=limits)
        assert left.count() == 10_004
        plan = left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    assert not moved, moved
    assert "BroadcastExchange" in plan and "SortMergeJoin" not in plan
