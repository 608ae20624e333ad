"""Shards by a hierarchical weighted hash tree.

The tree has regions, racks in regions and shards in racks. A key descends level by
level: at each level every child draws from the key's hash an exponential value, divided by
the child's weight, and the smallest draw wins, so a child is chosen in proportion to its
weight. A child's draw depends on the key, the child and its own weight only. When weights
change, keys leave or enter only subtrees whose weight changed; everything else stays.

Adding a shard inside a rack changes the weights of its rack and region, so keys that enter the
region may land on any of its shards. ``grown`` therefore opens a region of its own for
the new shard: keys then move into the new shard only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomvec.operators.ordering import with_positions

# Bytes counted for each row besides its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Node:
    """A region, a rack or (with ``shard``) a leaf. A parent weighs as much as its children."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0
    weight: float = field(init=False, default=0.0)

    def __post_init__(self):
        total = sum(c.weight for c in self.children) if self.children else float(self.own_weight)
        if self.shard is None and not self.children or total <= 0:
            raise ValueError(f"{self.name}: a node needs children or a shard, and a positive weight")
        object.__setattr__(self, "weight", total)

    def shards(self) -> list[int]:
        return [self.shard] if self.shard is not None else [s for c in self.children for s in c.shards()]


def grid(shards: int, per_rack: int = 5, racks: int = 2, weights: dict[int, float] | None = None) -> Node:
    """A tree of equal racks and regions filled in shard order; shards weigh 1 unless ``weights`` says otherwise."""
    leaves = [Node(f"shard{s}", shard=s, own_weight=(weights or {}).get(s, 1.0)) for s in range(shards)]
    made = [Node(f"rack{i}", tuple(leaves[i * per_rack : (i + 1) * per_rack])) for i in range(-(-shards // per_rack))]
    regions = [Node(f"region{i}", tuple(made[i * racks : (i + 1) * racks])) for i in range(-(-len(made) // racks))]
    return Node("root", tuple(regions))


def grown(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, numbered on, in a region of its own."""
    new = max(tree.shards()) + 1
    leaf = Node(f"shard{new}", shard=new, own_weight=weight)
    region = Node(f"region-of-shard{new}", (Node(f"rack-of-shard{new}", (leaf,)),))
    return Node(tree.name, (*tree.children, region))


def draw(key: Column, node: Node) -> Column:
    """The node's draw for a key: exponential, its rate the node's weight, from 52 bits of an MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"/{node.name}"))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / F.lit(node.weight)


def shard_of(key: Column, node: Node) -> Column:
    """The shard a key (a string, not null) descends to. Equal draws go to the earlier child."""
    if node.shard is not None:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return shard_of(key, node.children[0])
    draws = F.array(*[draw(key, child) for child in node.children])
    return F.transform(
        F.array(draws),
        lambda d: _descend(key, node, F.array_position(d, F.array_min(d))),
    )[0]


def _descend(key: Column, node: Node, place: Column) -> Column:
    step = None
    for i, child in enumerate(node.children[:-1]):
        hit = shard_of(key, child)
        step = F.when(place == i + 1, hit) if step is None else step.when(place == i + 1, hit)
    return step.otherwise(shard_of(key, node.children[-1]))


def assign_shards(docs: DataFrame, tree: Node, after: Node | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per row of ``docs (doc_id, text, ...)``.

    ``size`` is the UTF-8 length of the text plus 16; a null text counts as empty, with a CRC-32 of 0. The
    law is ``key``: doc_id and the tree alone decide, so rows of one doc_id share a shard whatever
    their text. A null doc_id is a key of its own. ``slot`` numbers a shard's rows from 0 without
    gaps, by doc_id (nulls first) and CRC-32; which of equal rows comes first is open. ``grown_shard`` is the
    shard in ``after``, null without it. Other columns of any name are ignored; no rows give no rows.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("string").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        shard_of(key, tree).cast("int").alias("shard"),
        (shard_of(key, after) if after else F.lit(None)).cast("int").alias("grown_shard"),
    )
    # Numbered over range-sorted partitions: a shard's rows are never one task.
    placed = with_positions(rows, ["shard"], ["doc_id", "text_crc32"], "slot", stage=True)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("slot") - 1).alias("slot"), "grown_shard"
    )
