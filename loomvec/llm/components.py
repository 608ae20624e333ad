"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomvec.session import discard, materialise

#: Edges that the driver joins by itself (1 MB); more go through rounds of written tables.
FEW = 1 << 16


def _joined(edges: DataFrame) -> DataFrame:
    """``(a, b)``: the smallest node of its component for every other node, of a table of few edges."""
    to: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := to.setdefault(x, x)) != x:
            to[x] = to.setdefault(up, up)
            x = to[x]
        return x

    for row in edges.collect():
        a, b = find(row.a), find(row.b)
        to[max(a, b)] = min(a, b)
    low = {x: find(x) for x in list(to)}
    nodes = [x for x in low if low[x] != x]
    found = pa.table({"a": pa.array(nodes, pa.int64()), "b": pa.array([low[x] for x in nodes], pa.int64())})
    return materialise(edges.sparkSession.createDataFrame(found), "stars")


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum((mixed % 1000003)), F.bit_xor(mixed)).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges (a long, b long)``; the component is its smallest node.

    Each round lets every node point its larger neighbours, then its smaller ones, at the
    smallest neighbour. Sums are combined before the shuffle and the join back splits hot
    nodes, so a node may touch any share of the edges. Rounds are written tables, and grow
    with the logarithm of the longest chain. At most ``FEW`` edges are joined on the driver. Self-loops and nulls give no rows.
    """
    a, b = F.col("a"), F.col("b")
    now = edges.where("a <> b").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now = materialise(now, "edges")
    state = _state(now)
    few = 0 < state[0] <= FEW
    if few:
        now = _joined(now)
    while state[0] and not few:
        both = now.union(now.select("b", "a"))
        lowest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        large = both.join(lowest, "a").where("b > a and b <> low").select(b.alias("a"), F.col("low").alias("b")).distinct()
        large = materialise(large, "stars")
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        near = large.join(lowest, "a")
        small = near.where("b <> low").select(b.alias("a"), F.col("low").alias("b")).union(
            lowest.select("a", F.col("low").alias("b"))
        )
        before, now = now, materialise(small.where("a <> b").distinct(), "stars")
        discard(before, large)
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
