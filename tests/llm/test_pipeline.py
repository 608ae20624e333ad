from __future__ import annotations

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from loomvec.llm import language_id, toxicity
from loomvec.llm.queries import ORACLES, QUERIES
from loomvec.session import materialise
from tests.llm import texts
from tests.llm.test_small_operators import reference_encoding
from tests.oracle import differences

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    rows, only_spark, only_sql = differences(spark, "/root/testdata/sf0.01", QUERIES[name], ORACLES[name])
    assert rows and not only_spark and not only_sql, (list(only_spark)[:3], list(only_sql)[:3])


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n in QUERIES) == list(range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5


def test_stages_on_awkward_rows_and_on_none(spark):
    """Every stage takes any rows of documents' columns and gives those columns back."""
    wanted = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (texts.frame(spark).select(*wanted), texts.empty(spark).select(*wanted)):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, SMALL), name)
            assert name == "tokens" or docs.columns == wanted
        assert docs.columns[0] == "doc_id"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        after[name] = materialise(stage(spark, docs, SMALL), name)
        before, docs = docs, after[name]
        ids = {r.doc_id for r in docs.collect()}
        if name == "language":
            judged = language_id.identify(before, language_id.fit(before))
            assert ids == {r.doc_id for r in judged.where("not rejected").collect()}
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
            assert ids == {r.doc_id for r in toxicity.score_documents(before, model).where("predicted = 0").collect()}
        if name == "near_copies":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert ids == {c for _, _, c in texts.components(rows, 5, 80)} and docs.count() == len(ids)
        if name == "mix":
            assert ids <= {r.doc_id for r in before.collect()}
    encoding = reference_encoding()
    text_of = {r.doc_id: r.text for r in after["mix"].collect()}
    for r in docs.collect():
        assert r.n_tokens == len(encoding.encode_ordinary(text_of[r.doc_id]))
    assert docs.count() == after["mix"].count()
    assert docs.where(F.col("ids").isNull()).count() == 0
