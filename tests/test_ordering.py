from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomvec.operators import batching, ordering
from loomvec.operators.ordering import with_positions
from loomvec.session import materialise, session_conf


def skewed(spark, n=20_000):
    """Half of all rows have one key; some keys are null."""
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("k"), F.col("id") % 50)
    )
    return spark.range(n).select("id", key.alias("k"), (F.xxhash64("id") % 1000).alias("v"))


def test_positions_equal_row_number(spark):
    rows = skewed(spark)
    found = with_positions(rows, ["k"], ["v", "id"])
    wanted = rows.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")))
    assert found.count() == rows.count()
    assert found.exceptAll(wanted.withColumn("position", F.col("position").cast("bigint"))).count() == 0


def test_positions_without_a_key(spark):
    rows = skewed(spark, 5000)
    for stage in (False, True):
        found = with_positions(rows, [], ["v", "id"], stage=stage)
        last = found.agg(F.min("position"), F.max("position"), F.countDistinct("position")).first()
        assert tuple(last) == (1, 5000, 5000)
    ordered = [row.position for row in found.orderBy("v", "id").collect()]
    assert ordered == list(range(1, 5001))


def test_a_hot_key_is_numbered_in_several_partitions(spark, monkeypatch):
    written = {}

    def remember(df, name):
        written[name] = materialise(df, name)
        return written[name]

    monkeypatch.setattr(ordering, "materialise", remember)
    with session_conf(spark, **{"adaptive.coalescePartitions.enabled": "false"}):
        with_positions(skewed(spark), ["k"], ["v", "id"])
    assert written["shifts"].where("k = 'hot'").count() > 1


def test_empty_input(spark):
    assert with_positions(skewed(spark, 0), ["k"], ["id"]).count() == 0


def test_batches_are_full_but_the_last(spark):
    rows = skewed(spark, 1000)
    batches = batching.assign_batches(rows, ["id"], 64, within=["k"])
    sizes = batches.groupBy("k", "batch").agg(F.count("*").alias("n"))
    last = sizes.withColumn("last", F.max("batch").over(Window.partitionBy("k")))
    assert last.where("batch < last AND n <> 64").count() == 0
    assert sizes.where("n > 64").count() == 0


def test_shuffled_batches_depend_on_the_seed_only(spark):
    rows = batching.assign_batches(skewed(spark, 1000), ["id"], 10)
    first = batching.shuffled_batches(rows, ["batch"], seed=1).orderBy("turn").collect()
    again = batching.shuffled_batches(rows.repartition(3), ["batch"], seed=1).orderBy("turn").collect()
    other = batching.shuffled_batches(rows, ["batch"], seed=2).orderBy("turn").collect()
    assert first == again
    assert [row.batch for row in first] != [row.batch for row in other]
    assert sorted(row.batch for row in other) == list(range(100))


def test_padding_order_needs_no_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 13).alias("n_tokens"))
    plan = batching.for_padding(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
