from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomvec.operators.ordering import with_running_sum
from loomvec.operators.quantiles import _bucket, exact_percentiles

PERCENTILES = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def check(spark, groups, group_rows):
    rows = [(key, float(v)) for key, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(6)
    found = {row.k: row for row in exact_percentiles(frame, ["k"], "v", PERCENTILES, group_rows).collect()}
    assert set(found) == set(groups)
    for key, values in groups.items():
        assert found[key].n == len(values)
        for name, p in PERCENTILES.items():
            assert found[key][name] == pytest.approx(np.percentile(values, p * 100), abs=1e-9), (key, name)


@pytest.mark.parametrize("group_rows", [1, 20, 400, 1_000_000])
def test_equal_to_numpy(spark, group_rows):
    rng = np.random.default_rng(1)
    check(
        spark,
        {
            "hot": rng.lognormal(size=9000),
            "ties": rng.integers(0, 5, size=3000),
            "constant": np.full(2000, 7.5),
            "two": [1.0, 2.0],
            "one": [3.0],
            "negative": -rng.exponential(size=500),
            "wide": rng.normal(size=800) * 10.0 ** rng.integers(-300, 300, 800),
            "tiny": [5e-324, 1e-323, -5e-324, 0.0, -0.0, 2.0],
        },
        group_rows,
    )


def test_many_small_sizes(spark):
    rng = np.random.default_rng(2)
    check(spark, {str(n): rng.normal(size=n) for n in range(1, 60)}, 10)


def test_a_hot_key_is_cut_until_its_buckets_are_small(spark):
    frame = spark.range(40_000).select(F.lit("hot").alias("k"), F.rand(3).alias("v"))
    found = exact_percentiles(frame, ["k"], "v", {"p50": 0.5}, group_rows=1000)
    wanted = frame.agg(F.percentile("v", F.lit(0.5))).first()[0]
    assert found.first().p50 == pytest.approx(wanted)


def test_running_sum_of_a_hot_key(spark):
    frame = spark.range(5000).select((F.col("id") % 50 == 0).alias("k"), "id", (F.col("id") % 7).alias("v"))
    plan = with_running_sum(frame, ["k"], ["id"], "v", "upto")
    assert "SinglePartition" not in plan._jdf.queryExecution().executedPlan().toString()
    found = {(r.k, r.id): r.upto for r in plan.collect()}
    for k in (True, False):
        total = 0
        for i in (i for i in range(5000) if (i % 50 == 0) == k):
            total += i % 7
            assert found[k, i] == total


def test_without_keys_and_without_rows(spark):
    frame = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert exact_percentiles(frame, [], "v", {"p50": 0.5}).first().p50 == 50.0
    assert exact_percentiles(frame.where("v < 0"), [], "v", {"p50": 0.5}).first().p50 is None
    assert exact_percentiles(frame.where("v < 0").withColumn("k", F.lit(1)), ["k"], "v", {"p50": 0.5}).count() == 0


def test_infinite_values_and_nan_come_last(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", x) for x in (nan, inf, -inf, 1.0, nan, 3.0, -2.0)] + [("b", nan), ("c", None), (None, 1.0), (None, 2.0)]
    frame = spark.createDataFrame(rows, "k string, v double")
    found = {r.k: r for r in exact_percentiles(frame, ["k"], "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}).collect()}
    assert set(found) == {"a", "b", None}
    assert (found["a"].n, found["a"].lo, found["a"].mid) == (7, -inf, 3.0) and np.isnan(found["a"].hi)
    assert np.isnan(found["b"].mid)
    assert (found[None].lo, found[None].mid, found[None].hi) == (1.0, 1.5, 2.0)


def test_buckets_never_fall_as_values_grow(spark):
    rng = np.random.default_rng(9)
    values = np.concatenate([rng.normal(size=5000) * 10.0 ** rng.integers(-320, 308, 5000), 2.0 ** np.arange(-1074, 1024, dtype=float), [0.0]])
    frame = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", _bucket(F.col("v")).alias("b"))
    rows = sorted(frame.collect(), key=lambda r: r.v)
    assert all(x.b <= y.b for x, y in zip(rows, rows[1:]))
