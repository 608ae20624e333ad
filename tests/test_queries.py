"""Every registered query against its SQL, over whole small tables."""

from __future__ import annotations

import pytest

from loomvec.plans.catalog import ORACLES, QUERIES
from tests.oracle import differences

SF_DIR = "/root/testdata/sf0.01"


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    rows, only_spark, only_sql = differences(spark, SF_DIR, QUERIES[name], ORACLES[name])
    assert not only_spark and not only_sql, (list(only_spark)[:3], list(only_sql)[:3])
    assert rows > 0
