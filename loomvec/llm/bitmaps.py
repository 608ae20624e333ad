"""A bit per hash value, in bounded memory: drops most rows that a later join would drop, and none it keeps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PAGE = 1 << 15  # bits of one row of Spark's bitmap functions


#: Bits of the largest bitmap (8 MB).
MOST_BITS = 26


def bitmap_of(rows: DataFrame, hashed: Column) -> np.ndarray:
    """A bit for the low bits of every ``hashed`` value, in a bitmap of about 16 bits a row.

    The bitmap stops growing at ``2 ** MOST_BITS`` bits: with more values it only lets more rows pass. Pages
    are put together by tasks, at most one per page and task, before they are shuffled.
    """
    bits = min(MOST_BITS, max(15, (16 * rows.count()).bit_length()))
    place = hashed.bitwiseAND(F.lit((1 << bits) - 1)) + 1
    pages = rows.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for page, held in pages.toLocalIterator():
        out[(page - 1) * _PAGE // 8 : page * _PAGE // 8] = np.frombuffer(held, dtype=np.uint8)
    return out


def may_hold(bitmap: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    place = hashed.view(np.uint64) & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
