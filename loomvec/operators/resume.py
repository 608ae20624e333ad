"""Resume: what is left to do, judged by the output itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomvec.operators.membership import Limits, without_members


def resume_pending(records: DataFrame, done: DataFrame, key: str = "id", limits: Limits = Limits()) -> DataFrame:
    """Records whose ``key`` is not in ``done`` yet; the records' texts are not shuffled.

    Records with a null key are always pending.
    """
    return without_members(records, done, key, limits)


def skip_existing_chunks(plan: DataFrame, manifest: DataFrame, key: str = "path") -> DataFrame:
    """Plan rows whose file no finished chunk of the manifest holds."""
    return resume_pending(plan, manifest, key)


def processed_total(output: DataFrame) -> DataFrame:
    return output.agg(F.count("*").alias("processed"))
