"""Choosing a configuration, and what it means for a corpus: time and cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def meets_target(p95_target: float = 10.0) -> Column:
    return (F.col("p95_s") <= p95_target) & (F.col("errors") == 0)


def best_config(trials: DataFrame, p95_target: float = 10.0) -> DataFrame:
    """The trial with the most tokens per second that meets the target; may be none.

    Trials that tie go to the lower ``trial_no``.
    """
    fit = trials.where(meets_target(p95_target))
    return fit.orderBy(F.desc("toks_s"), "trial_no").limit(1)


def scaling_factor(trials: DataFrame, is_baseline: Column, rate: str = "toks_s") -> DataFrame:
    """``scaling``: each trial's rate relative to the baseline trial's."""
    baseline = trials.where(is_baseline).agg(F.max(rate).alias("rate")).scalar()
    return trials.withColumn("scaling", F.col(rate) / baseline)


def capacity_estimate(
    trials: DataFrame,
    corpus_docs: Column | int,
    token_sizes: Sequence[Column | float],
    price_per_hour: Column | float = 0.0,
) -> DataFrame:
    """Hours and cost to embed a corpus, for every trial and average document size."""

    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    sizes = F.array(*[column(size).cast("double") for size in token_sizes])
    hours = F.col("corpus_docs") * F.col("avg_tok") / F.col("toks_s") / 3600
    return (
        trials.withColumn("corpus_docs", column(corpus_docs).cast("bigint"))
        .withColumn("avg_tok", F.explode(sizes))
        .withColumn("hours", hours)
        .withColumn("cost", F.col("hours") * column(price_per_hour))
    )


def cost_compare(estimates: DataFrame, option: str, options: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Options side by side: one row per metric, one column per option."""
    facts = F.explode(
        F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics]
        )
    )
    long = estimates.select(option, facts.alias("f")).select(option, "f.metric", "f.v")
    return long.groupBy("metric").pivot(option, list(options)).agg(F.first("v", ignorenulls=True))


def number_in_order(trials: DataFrame, order: Sequence[str]) -> DataFrame:
    """Give trials (a handful of rows) their ``trial_no`` by the order they ran in."""
    return trials.withColumn("trial_no", F.row_number().over(Window.orderBy(*order)))
