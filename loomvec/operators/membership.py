"""Exact membership of keys by a cascade of bitmaps, without moving the rows that ask.

The first bitmap holds a bit for the hash of every key of the set. Rows that miss it are outside. Of the keys that hit it,
those outside the set (found by a join of keys alone) go into a second, much smaller bitmap; the
members that hit that one by chance go into a third, and so on. So among the keys there are, the first bitmap
that a key misses tells exactly whether it is a member. Bitmaps are broadcast, so the
rows, with whatever wide columns they carry, stay in their scan's partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomvec.session import materialise

_PAGE_BITS = 1 << 15  # of one row of Spark's bitmap functions
_CHUNK_BITS = 1 << 9  # of one row of the broadcast table


@dataclass(frozen=True)
class Limits:
    """``most_bits`` and ``exact_bytes`` bound what is broadcast: a bitmap, and the keys the last bitmap leaves open."""

    bits_per_key: int = 16
    most_bits: int = 1 << 30
    exact_bytes: int = 8 << 20
    levels: int = 12


@dataclass(frozen=True)
class _Bitmap:
    chunks: DataFrame
    bits: int
    level: int

    def mark(self, rows: DataFrame, key: str) -> DataFrame:
        """``rows`` with a boolean ``_hit<level>``; the bitmap's chunks are broadcast, nothing is shuffled."""
        place = _place(F.col(key), self.level, self.bits)
        number, byte, bit = f"_chunk{self.level}", F.floor(F.col("_at") / 8).cast("int"), (F.col("_at") % 8).cast("int")
        asked = rows.withColumn("_place", place)
        asked = asked.withColumn(number, F.floor(F.col("_place") / _CHUNK_BITS)).withColumn("_at", F.col("_place") % _CHUNK_BITS)
        held = self.chunks.select(F.col("chunk").alias(number), F.col("bits").alias("_bits"))
        joined = asked.join(F.broadcast(held), number, "left")
        value = F.conv(F.hex(F.substring("_bits", byte + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.getbit(value, bit) == 1, F.lit(False))
        return joined.withColumn(f"_hit{self.level}", hit).drop("_place", "_at", "_bits", number)


def _place(key: Column, level: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), key), F.lit(bits))


def _bitmap(keys: DataFrame, key: str, count: int, level: int, limits: Limits) -> _Bitmap:
    """A bit per key; tasks put pages together before they are shuffled, and chunks without a bit are left out."""
    bits = min(limits.most_bits, max(8, 1 << (limits.bits_per_key * count).bit_length()))
    place = _place(F.col(key), level, bits) + 1
    pages = keys.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("page_bits")
    )
    each = _PAGE_BITS // _CHUNK_BITS
    size = _CHUNK_BITS // 8
    cut = pages.select("page", "page_bits", F.explode(F.sequence(F.lit(0), F.lit(each - 1))).alias("part"))
    chunks = cut.select(
        ((F.col("page") - 1) * each + F.col("part")).alias("chunk"), F.substring("page_bits", F.col("part") * size + 1, F.lit(size)).alias("bits")
    ).where(F.col("bits") != F.lit(bytes(size)))
    return _Bitmap(materialise(chunks, "bitmap"), bits, level)


def _size(keys: DataFrame, key: str) -> tuple[int, int]:
    count, length = keys.agg(F.count("*"), F.sum(F.octet_length(F.col(key).cast("string")) + 16)).first()
    return count, length or 0


def without_members(rows: DataFrame, members: DataFrame, key: str, limits: Limits = Limits()) -> DataFrame:
    """Rows of ``rows`` whose ``key`` is not among those of ``members``; null keys are never members.

    ``rows`` is read twice, the first time for its keys alone. Only keys are shuffled, as long as bitmaps and what they leave open stay within
    ``limits``. Beyond them the rows that hit all bitmaps, and only those, go through an anti join.
    """
    inside = materialise(members.select(key).where(F.col(key).isNotNull()).distinct(), "members")
    count, _ = _size(inside, key)
    if not count:
        return rows
    levels = [_bitmap(inside, key, count, 1, limits)]
    asked = levels[0].mark(rows.select(key).where(F.col(key).isNotNull()), key).where("_hit1").select(key).distinct()
    # Keys that hit the last bitmap by chance, and the keys that bitmap was made from.
    open_keys, made_from = materialise(asked.join(inside, key, "left_anti"), "open"), inside
    count, length = _size(open_keys, key)
    while length > limits.exact_bytes and len(levels) < limits.levels and count <= limits.most_bits:
        levels.append(_bitmap(open_keys, key, count, len(levels) + 1, limits))
        level = levels[-1]
        chance = materialise(level.mark(made_from.select(key), key).where(f"_hit{level.level}").select(key), "open")
        open_keys, made_from = chance, open_keys
        count, length = _size(open_keys, key)
    marked = rows
    for level in levels:
        marked = level.mark(marked, key)
    # A key that misses its first bitmap at an odd level is no member, at an even level it is one.
    member = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        member = F.when(~F.col(f"_hit{level.level}"), level.level % 2 == 0).otherwise(member)
    member = F.coalesce(member & F.col(key).isNotNull(), F.lit(False))
    hits = [f"_hit{level.level}" for level in levels]
    every = F.lit(True)
    for hit in hits:
        every = every & F.col(hit)
    every = F.coalesce(every & F.col(key).isNotNull(), F.lit(False))
    if not count:
        return marked.where(~member).select(rows.columns)
    # The keys still open are of the other kind than those the last bitmap was made from.
    if length <= limits.exact_bytes:
        exact = F.broadcast(open_keys.select(F.col(key).alias("_key"), F.lit(True).alias("_open")))
        joined = marked.join(exact, F.when(every, F.col(key)) == F.col("_key"), "left")
        return joined.where(~member.eqNullSafe(F.col("_open").isNull())).select(rows.columns)
    settled = marked.where(~every & ~member).select(rows.columns)
    kind = "left_semi" if len(levels) % 2 == 1 else "left_anti"
    return settled.unionByName(marked.where(every).select(rows.columns).join(open_keys, key, kind))
