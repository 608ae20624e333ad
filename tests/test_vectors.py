from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomvec.functions import vectors


def one(spark, column, type_="array<float>", value=None):
    return spark.createDataFrame([(value,)], f"v {type_}").select(column).first()[0]


@pytest.mark.parametrize(
    ("value", "expected"),
    [([3.0, 4.0], [0.6, 0.8]), ([0.0, 0.0], [0.0, 0.0]), ([], []), ([-5.0], [-1.0])],
)
def test_l2_normalize(spark, value, expected):
    assert one(spark, vectors.l2_normalize(F.col("v")), value=value) == pytest.approx(expected)


def test_truncate_keeps_unit_length(spark):
    value = [float(x) for x in np.random.default_rng(0).normal(size=768)]
    short = one(spark, vectors.truncate_embedding(F.col("v"), 256), value=value)
    wanted = np.array(value[:256], dtype=np.float32)
    assert len(short) == 256
    assert np.allclose(short, wanted / np.linalg.norm(wanted), atol=1e-6)
    ragged = one(spark, vectors.truncate_embedding(F.col("v"), 256), value=[1.0, 1.0])
    assert ragged == pytest.approx([0.5**0.5] * 2)


def test_null_vectors_stay_null(spark):
    assert one(spark, vectors.truncate_embedding(F.col("v"), 4)) is None


def test_unwrap_nested(spark):
    nested = "array<array<float>>"
    assert one(spark, vectors.unwrap_nested(F.col("v")), nested, [[1.0, 2.0]]) == [1.0, 2.0]
    assert one(spark, vectors.unwrap_nested(F.col("v")), nested, [[1.0], [2.0]]) is None


def test_point_json(spark):
    payload = one(spark, vectors.point_json(F.lit("a"), F.col("v")), value=[0.5, -1.0])
    assert json.loads(payload) == {"id": "a", "embedding": [0.5, -1.0]}
    assert json.loads(one(spark, vectors.vector_json(F.col("v")), value=[0.5])) == [0.5]
