"""Trial results as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIAL_COLUMNS = [
    "batch", "conc", "docs", "tokens", "docs_s", "toks_s", "p50_s", "p95_s", "errors", "dur",
]
_TYPES = {
    "batch": "int", "conc": "int", "docs": "bigint", "tokens": "bigint",
    "docs_s": "double", "toks_s": "double", "p50_s": "double", "p95_s": "double",
    "errors": "int", "dur": "double",
}
TRIAL_SCHEMA = ", ".join(f"{name} {_TYPES[name]}" for name in TRIAL_COLUMNS)


def write_trials(trials: DataFrame, path: str) -> None:
    """One CSV file with a header; trials are one row per configuration."""
    order = ["trial_no"] if "trial_no" in trials.columns else ["batch", "conc"]
    table = trials.coalesce(1).sortWithinPartitions(*order).select(*TRIAL_COLUMNS)
    table.write.mode("overwrite").csv(path, header=True)


def read_trials(spark: SparkSession, path: str, with_dur: bool = True) -> DataFrame:
    """Trial rows; tables written without ``dur`` get it as null."""
    names = TRIAL_COLUMNS if with_dur else TRIAL_COLUMNS[:-1]
    schema = ", ".join(f"{name} {_TYPES[name]}" for name in names)
    table = spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
    return table if with_dur else table.withColumn("dur", F.lit(None).cast("double"))
