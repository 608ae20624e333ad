"""Batch and chunk numbers for reporting and for load planning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomvec.functions.lengths import bucket_high, bucket_low
from loomvec.operators.ordering import with_positions


def _numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, name: str, stage: bool = False
) -> DataFrame:
    placed = with_positions(df, keys, order, "_at", stage)
    return placed.withColumn(name, F.floor((F.col("_at") - 1) / size)).drop("_at")


def assign_chunks(df: DataFrame, order: Sequence[str], size: int = 1_000_000) -> DataFrame:
    """``chunk``: every ``size`` consecutive rows in ``order``."""
    return _numbered(df, [], order, size, "chunk")


def assign_batches(
    df: DataFrame, order: Sequence[str], size: int = 256, within: Sequence[str] = ()
) -> DataFrame:
    """``batch``: every ``size`` consecutive rows; a batch never crosses a ``within`` group."""
    return _numbered(df, within, order, size, "batch")


def bucketed_batches(df: DataFrame, order: Sequence[str], size: int = 32) -> DataFrame:
    """Batches that mix only rows of one length bucket of ``n_tokens``."""
    n_tokens = F.col("n_tokens")
    bucketed = df.withColumn("bucket_lo", bucket_low(n_tokens)).withColumn(
        "bucket_hi", bucket_high(n_tokens)
    )
    return _numbered(bucketed, ["bucket_lo", "bucket_hi"], order, size, "batch", stage=True)


def bucket_counts(df: DataFrame) -> DataFrame:
    n_tokens = F.col("n_tokens")
    return df.groupBy(bucket_low(n_tokens).alias("bucket_lo"), bucket_high(n_tokens).alias("bucket_hi")).agg(
        F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")
    )


def shuffled_batches(batches: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """The distinct batches in a seeded random order, ``turn`` counting from 1.

    The order follows a hash of the seed and the batch, so it is the same however
    the rows are partitioned.
    """
    name = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    drawn = batches.groupBy(*keys).agg(F.count("*").alias("docs")).withColumn("_draw", F.md5(name))
    return with_positions(drawn, [], ["_draw", *keys], "turn", stage=True).drop("_draw")


def for_padding(rows: DataFrame) -> DataFrame:
    """Sort each partition by length so that a task's batches need little padding; no shuffle."""
    return rows.sortWithinPartitions("n_tokens")
