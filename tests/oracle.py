"""Compare a query with its SQL in DuckDB, as bags of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else (None if math.isnan(value) else round(value, 6))
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, sf_dir, build, sql):
    """``(rows, only in Spark, only in SQL)``; column names have to match."""
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    wanted = connection.execute(sql)
    sql_columns = [column[0] for column in wanted.description]
    sql_types = {column[0]: TYPES.get(str(column[1]), str(column[1])) for column in wanted.description}
    sql_bag = _bag(sql_columns, wanted.fetchall())
    frame = build(spark, sf_dir)
    assert sorted(frame.columns) == sorted(sql_columns), (frame.columns, sql_columns)
    assert dict(frame.dtypes) == sql_types, (dict(frame.dtypes), sql_types)
    spark_bag = _bag(frame.columns, [tuple(row) for row in frame.collect()])
    return sum(spark_bag.values()), spark_bag - sql_bag, sql_bag - spark_bag
