"""Vectors as integers: which rows take part, and their scaled components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Beyond this size sums of squares of a few hundred components could leave 64 bits.
MOST = 1 << 27


def is_whole(vector: Column) -> Column:
    """True for a vector that is not null and holds finite components only."""
    value = vector.cast("array<double>")
    return value.isNotNull() & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def scaled(vectors: DataFrame, scale: int) -> DataFrame:
    """``(vec_id, label, v array<int>)``: rows with whole vectors, each component x as ``floor(scale * x)``, x as double.

    A component that leaves +-2**27 stops the job: the sums asked for would not fit a long.
    """
    value = F.col("embedding").cast("array<double>")
    whole = vectors.where(is_whole(F.col("embedding")))
    rows = whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), value.alias("x"))

    def one(x: Column) -> Column:
        grown = F.floor(x * F.lit(float(scale)))
        fits = F.abs(x) < F.lit(MOST / scale)
        return F.when(fits, grown).otherwise(F.raise_error(F.lit(f"a component times {scale} leaves +-2**27"))).cast("int")

    return rows.select("vec_id", "label", F.transform("x", one).alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as one matrix; the column holds lists without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) and len(flat) else np.zeros((len(column), 0), flat.dtype)
