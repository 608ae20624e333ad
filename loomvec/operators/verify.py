"""Checks of finished tables: per-file reports, fingerprints, and differences by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomvec.sources.shards import inspect_shards, list_shards


def file_report(spark: SparkSession, *paths: str) -> DataFrame:
    """Readable, rows and columns of each Parquet file, from the footers."""
    report = inspect_shards(list_shards(spark, *paths), ignore_extra=True)
    return report.select("path", "dir", "readable", "rows", "columns", "error")


def rows_per_file(table: DataFrame) -> DataFrame:
    """Rows per file of a file-based table, counted by reading it."""
    return table.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("rows"))


def fingerprint(table: DataFrame, key: str = "id") -> DataFrame:
    """Row count and order-free hash sums of ids and of whole rows: one pass, one row, no shuffle of rows."""

    def total(*columns: str):
        return F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(20,0)")), F.lit(0).cast("decimal(20,0)"))

    others = [c for c in table.columns if c != key]
    return table.agg(F.count("*").alias("rows"), total(key).alias("id_sum"), total(key, *sorted(others)).alias("row_sum"))


def count_differences(source: DataFrame, output: DataFrame, key: str = "id") -> DataFrame:
    """Ids that are not as often in ``output`` as in ``source``, with both counts.

    Both sides are stacked and counted in one aggregation, which combines repeats
    of an id before the shuffle.
    """
    stacked = source.select(F.col(key), F.lit(1).alias("s"), F.lit(0).alias("o")).unionByName(
        output.select(F.col(key), F.lit(0).alias("s"), F.lit(1).alias("o"))
    )
    counts = stacked.groupBy(key).agg(F.sum("s").alias("in_source"), F.sum("o").alias("in_output"))
    return counts.where(F.col("in_source") != F.col("in_output"))


def reconcile(source: DataFrame, output: DataFrame, key: str = "id") -> DataFrame:
    """One row: rows on both sides, and whether the ids, and the rows with their vectors, agree as a bag."""
    left, right = fingerprint(source, key), fingerprint(output, key)
    both = left.withColumn("side", F.lit("s")).unionByName(right.withColumn("side", F.lit("o")))

    def side(name: str, column: str):
        return F.max(F.when(F.col("side") == name, F.col(column)))

    return both.agg(
        side("s", "rows").alias("source_rows"),
        side("o", "rows").alias("output_rows"),
        (side("s", "id_sum").eqNullSafe(side("o", "id_sum"))).alias("same_ids"),
        (side("s", "row_sum").eqNullSafe(side("o", "row_sum"))).alias("same_rows"),
    )
