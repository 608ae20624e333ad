"""Compute an expensive column one time, whatever is filtered on it later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that later filters read instead of computing it again.

    A filter on a projected expression is moved below the projection, which then
    evaluates the expression twice. Exploding a one-element array keeps it in place.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(column)).alias(name))
