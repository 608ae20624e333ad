"""Plans: what reaches the scan, what is shuffled, and what is computed once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomvec.operators import request_log
from loomvec.operators.embed import embed_records, prepare_texts
from loomvec.operators.ordering import with_positions
from loomvec.operators.resume import resume_pending
from loomvec.plans.catalog import QUERIES
from loomvec.session import session_conf
from loomvec.sources.tables import read_table

SF_DIR = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def records(spark):
    docs = read_table(spark, f"{SF_DIR}/documents.parquet")
    return docs.select(F.col("doc_id").cast("string").alias("id"), "text")


def test_cleaning_reads_two_columns_and_cleans_once(spark):
    plan = plan_of(prepare_texts(records(spark)))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "IsNotNull(text), Not(EqualTo(text,))" in plan
    assert plan.count("https?://") == 1
    assert "Exchange" not in plan


def test_embedding_is_map_only(spark):
    assert "Exchange" not in plan_of(embed_records(prepare_texts(records(spark))))


def test_resume_moves_no_text(spark):
    done = records(spark).select("id")
    with session_conf(spark, autoBroadcastJoinThreshold="-1"):
        plan = plan_of(resume_pending(records(spark), done))
    assert "SortMergeJoin" not in plan
    assert all("BroadcastExchange" in line for line in plan.splitlines() if "Exchange" in line)


@pytest.mark.parametrize("name", ["truncate_embedding", "l2_normalize", "vector_json", "cast_float32", "strip_urls", "clean_text", "estimate_tokens", "blank_if_null"])
def test_projections_shuffle_nothing(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_ticks_are_summed_before_the_shuffle(spark):
    plan = plan_of(QUERIES["interval_rate"](spark, SF_DIR))
    assert "partial_sum" in plan
    assert "props" not in plan


def test_positions_never_use_one_partition(spark):
    rows = spark.range(1000).select("id", F.lit("hot").alias("k"))
    for keys in ([], ["k"]):
        assert "SinglePartition" not in plan_of(with_positions(rows, keys, ["id"]))


def test_a_trial_is_put_together_from_written_sums_and_samples(spark):
    log = QUERIES["run_totals"].__globals__["log"](spark, SF_DIR)
    plan = plan_of(request_log.trial_metrics(log))
    assert "events.parquet" not in plan
