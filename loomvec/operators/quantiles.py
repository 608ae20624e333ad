"""Exact percentiles by radix selection: one pass for a histogram, one for the buckets that hold the wanted ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomvec.operators.joins import join_on
from loomvec.session import materialise

# Buckets of the first pass for each doubling of a value, and of a bucket that is cut again.
PER_DOUBLING = 64
PER_BUCKET = 4096
# A double is at least 2 ** -1074.
_LOWEST, _HIGHEST = -1080, 1030


def _bucket(value: Column) -> Column:
    """A bucket number that never falls as a double grows; NaN comes last."""
    size = F.floor((F.least(F.log2(F.abs(value)), F.lit(float(_HIGHEST))) - _LOWEST) * PER_DOUBLING)
    return F.when(F.isnan(value), F.lit(1 << 40)).when(value > 0, size).when(value < 0, -size).otherwise(0).cast("bigint")


def _histogram(placed: DataFrame, groups: Sequence[str], *carried: str) -> DataFrame:
    """Rows, smallest and largest value of every bucket; combined before the shuffle, and written."""
    facts = [F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    return materialise(placed.groupBy(*groups).agg(*facts, *[F.first(c).alias(c) for c in carried]), "histogram")


def _ranks_in(spots: Column, before: Column, upto: Column) -> Column:
    """Of ``(spot, rank, n)`` those with a rank from ``before`` up to ``upto``, counted from ``before``."""
    inside = F.filter(spots, lambda s: (s["rank"] >= before) & (s["rank"] < upto))
    return F.transform(inside, lambda s: F.struct(s["spot"].alias("spot"), (s["rank"] - before).alias("rank"), s["n"].alias("n")))


def _wanted(histogram: DataFrame, within: Sequence[str], bucket: str, spots: Column) -> DataFrame:
    """The buckets in which a wanted rank lies, with those ranks."""
    order = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    summed = histogram.withColumn("_upto", F.sum("_n").over(order))
    held = summed.withColumn("_spots", _ranks_in(spots, F.col("_upto") - F.col("_n"), F.col("_upto"))).drop("_upto")
    return held.where(F.size("_spots") > 0)


def _settled(placed: DataFrame, wanted: DataFrame, groups: list[str], group_rows: int) -> list[DataFrame]:
    """``(..., _spot, _n, _v)``: the values at the wanted ranks of each bucket, as tables to be stacked."""
    wanted = materialise(wanted, "wanted")

    def shown(rows: DataFrame, value: str) -> DataFrame:
        one = rows.select(*groups, F.col(value).alias("_value"), F.explode("_spots").alias("_s"))
        return one.select(*groups, F.col("_s.spot").alias("_spot"), F.col("_s.n").alias("_n"), F.col("_value").alias("_v"))

    found = [shown(wanted.where("_lo = _hi"), "_lo")]
    # Few rows: their different values in order, one task a bucket.
    few = wanted.where(f"_lo <> _hi AND _n <= {group_rows}").select(*groups, "_spots")
    counted = join_on(placed.select(*groups, "_v"), few, groups).groupBy(*groups, "_v").agg(F.count("*").alias("_c"), F.first("_spots").alias("_spots"))
    upto = F.sum("_c").over(Window.partitionBy(*groups).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    counted = counted.withColumn("_upto", upto)
    counted = counted.withColumn("_spots", _ranks_in(F.col("_spots"), F.col("_upto") - F.col("_c"), F.col("_upto")))
    found.append(shown(counted.where(F.size("_spots") > 0), "_v"))
    many = wanted.where(f"_lo <> _hi AND _n > {group_rows}")
    if many.isEmpty():
        return found
    # Many rows: the bucket is cut again between its smallest and largest value.
    inside = join_on(placed.select(*groups, "_v"), many.select(*groups, "_lo", "_hi", "_spots"), groups)
    finer = f"_b{len(groups)}"
    share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    inside = materialise(inside.withColumn(finer, F.floor(share * (PER_BUCKET - 1))).drop("_lo", "_hi"), "inside")
    again = _histogram(inside, [*groups, finer], "_spots")
    rest = _settled(inside, _wanted(again, groups, finer, F.col("_spots")), [*groups, finer], group_rows)
    return found + [table.drop(finer) for table in rest]


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percentiles: Mapping[str, float],
    group_rows: int = 1_000_000,
) -> DataFrame:
    """Per key the linearly interpolated percentiles of ``value``, and ``n``.

    All keys and percentiles at once. The first pass counts each key's values in buckets of their sign and logarithm, of which there are
    64 for each doubling; the second looks only at the buckets that hold a wanted rank. Both are
    combined before the shuffle. A bucket of more than ``group_rows`` rows is cut into 4,096 finer ones first, as often as it takes, so
    no task orders more rows than that whatever share of them a key has. Keys with no
    value get no row. ``df`` is read twice: write it first if it is costly.
    """
    keys, names = list(keys), list(percentiles)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    placed = rows.withColumn("_b", _bucket(F.col("_v")))
    histogram = _histogram(placed, [*keys, "_b"])
    n = F.sum("_n").over(Window.partitionBy(*keys))
    spots = F.array(*[
        F.struct(F.lit(2 * i + up).alias("spot"), side(F.lit(float(percentiles[name])) * (n - 1)).cast("bigint").alias("rank"), n.alias("n"))
        for i, name in enumerate(names) for up, side in enumerate((F.floor, F.ceil))
    ])
    wanted = _wanted(histogram.withColumn("_every", spots), keys, "_b", F.col("_every")).drop("_every")
    found = reduce(DataFrame.unionByName, _settled(placed, wanted, [*keys, "_b"], group_rows))
    at = lambda spot: F.max(F.when(F.col("_spot") == spot, F.col("_v")))

    def between(i: int, name: str) -> Column:
        target = F.lit(float(percentiles[name])) * (F.max("_n") - 1)
        part = target - F.floor(target)
        return F.when(part == 0, at(2 * i)).otherwise(at(2 * i) * (1 - part) + at(2 * i + 1) * part).alias(name)

    return found.groupBy(*keys).agg(F.max("_n").alias("n"), *[between(i, name) for i, name in enumerate(names)])
