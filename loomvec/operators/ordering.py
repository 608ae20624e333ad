"""Exact row positions without putting a whole key into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomvec.operators.joins import join_on
from loomvec.session import materialise

# monotonically_increasing_id keeps the row number of a partition in its low 33 bits.
_ROW_BITS = 33


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    stage: bool = False,
) -> DataFrame:
    """Add the 1-based position of every row within its key.

    Equal to ``row_number() over (partition by keys order by order)``, but a key
    may be any share of the data: rows are range-sorted over all partitions by
    ``keys + order``, numbered inside their partition, and shifted by the size of
    the same key's earlier partitions. ``order`` has to end in a unique column.
    Project to the needed columns first: the sorted rows are written once. A range
    sort reads its input twice, for the bounds and for the rows; ``stage`` writes the
    input first where that is cheaper than computing it twice.
    """
    keys = list(keys)
    if stage:
        df = materialise(df, "staged")
    laid = materialise(
        df.orderBy(*keys, *order).withColumn("_row", F.monotonically_increasing_id()),
        "positions",
    )
    laid = laid.withColumn("_part", F.shiftright("_row", _ROW_BITS))
    runs = laid.groupBy(*keys, "_part").agg(F.count("*").alias("_size"), F.min("_row").alias("_first"))
    # At most one row per (key, partition), so a hot key has as many as there are partitions.
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    shifts = materialise(
        runs.select(*keys, "_part", (before - F.col("_first") + 1).alias("_shift")), "shifts"
    )
    return join_on(laid, shifts, [*keys, "_part"]).select(
        *df.columns, (F.col("_row") + F.col("_shift")).alias(name)
    )


def with_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, name: str) -> DataFrame:
    """Add the sum of ``amount`` up to each row, within its key and in ``order``.

    Equal to ``sum(amount) over (partition by keys order by order rows up to the current one)``, but a key may
    be any share of the data, as in :func:`with_positions`: sums run inside a partition of the range sort
    and are shifted by what the key has in earlier partitions. The sorted rows are written once.
    """
    keys = list(keys)
    laid = materialise(df.orderBy(*keys, *order).withColumn("_row", F.monotonically_increasing_id()), "running")
    laid = laid.withColumn("_part", F.shiftright("_row", _ROW_BITS))
    inside = Window.partitionBy(*keys, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    parts = laid.groupBy(*keys, "_part").agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(*keys, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    summed = laid.withColumn("_inside", F.sum(amount).over(inside))
    return join_on(summed, shifts, [*keys, "_part"]).select(*df.columns, (F.col("_inside") + F.col("_shift")).alias(name))
