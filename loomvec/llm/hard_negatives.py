"""Hard negatives by exact integer products in a residue number system.

Components are integers. Modulo a few primes below 1,024 their centred residues are so small that a product of
float32 matrices over a block of columns is exact; the products are reduced modulo each prime, and Chinese
remaindering gives back the signed score. As many primes are taken as the longest vector's
squared length calls for, so every score is exact however the rows are dealt.

Rows lie in blocks of bounded size. The anchors pass by each block in Arrow batches: a first pass keeps the best rows of
an anchor's label, a second one the best rows of other labels inside the windows that those positives open.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomvec.llm.vectors import matrix, scaled
from loomvec.session import materialise

# The largest primes below 1024.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)

# Centred residues are at most 510, and 64 products of two of them stay below 2**24.
COLUMNS = 64


@dataclass(frozen=True)
class Settings:
    """``block`` bounds the rows a task holds at once, ``cells`` the scores; the window is in hundredths of a positive's score."""

    scale: int = 256
    every: int = 100
    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    block: int = 32_768
    least_blocks: int = 12
    cells: int = 1 << 21


def primes_for(bound: int) -> list[int]:
    """So many primes that their product exceeds all scores from ``-bound`` to ``bound``."""
    taken, product = [], 1
    for prime in PRIMES:
        if taken and product > 2 * bound:
            break
        taken.append(prime)
        product *= prime
    if product <= 2 * bound or product >= 1 << 63:
        raise ValueError("scores of these vectors leave 62 bits")
    return taken


class Residues:
    """A matrix of integers as centred residues modulo each prime."""

    def __init__(self, values: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [((values + p // 2) % p - p // 2).astype(np.float32) for p in primes]

    def products(self, other: Residues) -> np.ndarray:
        """Exact signed inner products of all rows with all rows of ``other``."""
        found, radix = None, 1
        for p, own, others in zip(self.primes, self.parts, other.parts):
            rest = np.zeros((len(own), len(others)), np.int64)
            for at in range(0, own.shape[1], COLUMNS):
                rest += (own[:, at : at + COLUMNS] @ others[:, at : at + COLUMNS].T).astype(np.int64)
            rest %= p
            if found is None:
                found = rest
            else:
                # The next mixed-radix digit.
                found = found + radix * ((rest - found) % p * pow(radix, -1, p) % p)
            radix *= p
        return np.where(found > radix // 2, found - radix, found)


@dataclass
class Block:
    """Rows of one block, by vec_id, as residues."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    length: int
    residues: Residues

    def best(self, scores: np.ndarray, allowed: np.ndarray, n: int) -> np.ndarray:
        """The first ``n`` of the places ``allowed`` by score, highest first, then vec_id."""
        if len(allowed) > 4 * n:
            mine = scores[allowed]
            bar = np.partition(mine, len(mine) - n)[len(mine) - n]
            allowed = allowed[mine >= bar]
        order = np.lexsort((self.row[allowed], self.vec_id[allowed], -scores[allowed]))
        return allowed[order[:n]]


def _passing(batches: Iterator[pa.RecordBatch], primes: list[int], settings: Settings) -> Iterator[tuple[pa.RecordBatch, Block, np.ndarray]]:
    """``(anchors, block, scores)`` as anchors pass by their block; rows come sorted by block, each block's own rows first."""
    held: list[pa.RecordBatch] = []
    block, key = None, None
    for batch in batches:
        keys = batch.column("block").to_numpy()
        lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
        sides = batch.column("side").to_numpy()
        cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(lengths) != 0) | (np.diff(sides) != 0)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if begin == end:
                continue
            part = batch.slice(begin, end - begin)
            here = (int(lengths[begin]), int(keys[begin]))
            if here != key:
                held, block, key = [], None, here
            if sides[begin] == 0:
                held.append(part)
                continue
            if not held and block is None:
                continue  # no row of this length in the block
            if block is None:
                block = _block(held, here[0], primes)
                held = []
            step = max(1, settings.cells // len(block.row))
            for at in range(0, part.num_rows, step):
                asked = part.slice(at, step)
                asks = Residues(matrix(asked.column("v")).astype(np.int64), primes)
                yield asked, block, asks.products(block.residues)


def _block(held: list[pa.RecordBatch], length: int, primes: list[int]) -> Block:
    get = lambda name: np.concatenate([b.column(name).to_numpy() for b in held])
    values = np.concatenate([matrix(b.column("v")) for b in held])
    return Block(get("row"), get("vec_id"), get("label"), length, Residues(values.astype(np.int64), primes))


def _positives(batches: Iterator[pa.RecordBatch], primes: list[int], settings: Settings) -> Iterator[pa.RecordBatch]:
    for asked, block, scores in _passing(batches, primes, settings):
        out = []
        for i, (row, label) in enumerate(zip(asked.column("row").to_pylist(), asked.column("label").to_pylist())):
            same = np.flatnonzero((block.label == label) & (block.row != row))
            out += [(row, int(block.row[at]), int(block.vec_id[at]), int(scores[i, at])) for at in block.best(scores[i], same, settings.positives)]
        yield _batch(out, ["anchor", "row", "vec_id", "score"])


def _negatives(batches: Iterator[pa.RecordBatch], primes: list[int], settings: Settings) -> Iterator[pa.RecordBatch]:
    for asked, block, scores in _passing(batches, primes, settings):
        out = []
        asks = zip(asked.column("row").to_pylist(), asked.column("label").to_pylist(), asked.column("tops").to_pylist())
        for i, (row, label, tops) in enumerate(asks):
            lows = [-(-settings.low * top // 100) for top in tops]
            highs = [settings.high * top // 100 for top in tops]
            mine = scores[i]
            other = np.flatnonzero((mine >= min(lows)) & (mine <= max(highs)) & (block.label != label))
            for top, low, high in zip(tops, lows, highs):
                inside = other[(mine[other] >= low) & (mine[other] <= high)]
                out += [(row, top, int(block.row[at]), int(block.vec_id[at]), int(mine[at])) for at in block.best(mine, inside, settings.negatives)]
        yield _batch(out, ["anchor", "top", "row", "vec_id", "score"])


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names=names)


def _by_blocks(rows: DataFrame, anchors: DataFrame, blocks: int, work: Callable, schema: str) -> DataFrame:
    """``work`` over every block, whose rows are followed by all anchors."""
    fields = ["block", "side", "row", "vec_id", "label", "v", "tops"]
    dealt = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    left = rows.withColumn("block", dealt).withColumn("side", F.lit(0)).withColumn("tops", F.lit(None).cast("array<long>"))
    # Of an anchor only its label, vector and windows go to the blocks.
    right = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("side", F.lit(1))
    both = left.select(fields).union(right.select(fields)).repartition("block")
    return both.sortWithinPartitions("block", F.size("v"), "side", "vec_id", "row").mapInArrow(work, schema)


def _first(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of all anchors.

    Rows with a null vec_id or label, a null vector, or a null or non-finite component take no part. A repeated vec_id is as many
    rows, each of which may be another's positive or negative; an anchor that is there twice gives its rows twice.
    Vectors of different lengths have no score with each other. Anchors without positives, and positives whose window holds
    no row, give none; an empty table gives none. Other columns are ignored. A component beyond +-2**27 / scale, or
    scores beyond 62 bits, are errors.
    """
    spark = vectors.sparkSession
    rows = scaled(vectors, settings.scale).where("vec_id is not null and label is not null")
    # Numbers that a written table fixes; equal vec_ids stay apart by them.
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    square = F.aggregate("v", F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x.cast("decimal(19,0)") * x).cast("decimal(38,0)"))
    total, bound = rows.agg(F.count("*"), F.max(square)).first()
    if not total:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    primes = primes_for(int(bound))
    blocks = max(settings.least_blocks, -(-total // settings.block))
    anchors = rows.where(F.col("vec_id") % settings.every == 0)
    found = _by_blocks(
        rows, anchors.withColumn("tops", F.lit(None).cast("array<long>")), blocks,
        lambda batches: _positives(batches, primes, settings), "anchor long, row long, vec_id long, score long",
    )
    positives = materialise(_first(found, ["anchor"], settings.positives), "positives")
    tops = positives.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_set("score")).alias("tops"))
    found = _by_blocks(
        rows, anchors.join(tops, "row"), blocks,
        lambda batches: _negatives(batches, primes, settings), "anchor long, top long, row long, vec_id long, score long",
    )
    negatives = _first(found, ["anchor", "top"], settings.negatives)
    negatives = negatives.select("anchor", "top", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = positives.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("top"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return ids.join(pairs, "anchor").join(negatives, ["anchor", "top"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("top").alias("positive_score"), "negative_score"
    )
