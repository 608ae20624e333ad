"""Token-length buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Closed ranges of token counts, and the range for anything longer.
LENGTH_BUCKETS = [
    (0, 32), (33, 64), (65, 96), (97, 128), (129, 192), (193, 256),
    (257, 512), (513, 768), (769, 1024), (1025, 1536), (1537, 2048),
]
OVERFLOW_BUCKET = (2049, 4096)


def _pick(n_tokens: Column, side: int) -> Column:
    chosen = F.lit(OVERFLOW_BUCKET[side])
    for bounds in reversed(LENGTH_BUCKETS):
        chosen = F.when(n_tokens.between(*bounds), bounds[side]).otherwise(chosen)
    return chosen


def bucket_low(n_tokens: Column) -> Column:
    return _pick(n_tokens, 0)


def bucket_high(n_tokens: Column) -> Column:
    return _pick(n_tokens, 1)
