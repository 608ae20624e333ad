"""Words and word shingles of many texts at once, as numpy arrays.

A slice of an Arrow string column is one byte array with offsets. Words are the runs
between white space (space and 0x09 to 0x0D), with A-Z lower-cased; each gets a 64-bit
hash from prefix sums, so no Python loop runs per word: its letters as a polynomial modulo two primes (a polynomial
modulo a power of two would be the same for certain pairs of long words whatever its base). Equality of words and shingles
is decided by these hashes.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Texts are handled in slices of about this many bytes, which bounds memory per task (numpy's
# steps hold some 50 bytes for each); one longer text is a slice of its own.
SLICE_BYTES = 1 << 18

# Rows of one Arrow batch: with the usual 10,000, batches of long texts fill an executor's memory.
BATCH_ROWS = 1000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything but ASCII letters, digits and bytes of longer characters.
NOT_ALNUM = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])
_STEP = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95
#: Primes, and a base for each.
_FIELDS = ((2147483647, 1583458089), (2147483629, 784588716))
_powers: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, np.uint32), np.ones(1, np.uint32))] * len(_FIELDS)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTERS = [mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP + prime)) % np.uint64(prime - 1) + np.uint64(1) for prime, _ in _FIELDS]


def _powers_of(base: int, prime: int, size: int) -> np.ndarray:
    made = np.ones(1, np.uint64)
    while len(made) < size:
        made = np.concatenate((made, made * np.uint64(pow(base, len(made), prime)) % np.uint64(prime)))
    return made[:size].astype(np.uint32)


def _powers_to(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse, kept between calls."""
    global _powers
    if len(_powers[0][0]) < n:
        size = 1 << (n - 1).bit_length()
        _powers = [(_powers_of(base, prime, size), _powers_of(pow(base, -1, prime), prime, size)) for prime, base in _FIELDS]
    return _powers


def short_batches(spark: SparkSession) -> None:
    """Let the session hand texts to Python in batches of few rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def give_back() -> None:
    """Let the process return memory it no longer uses: the driver of a long pipeline fits one model after another, and
    a worker process runs tasks of all its stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def returning(batches: Iterator) -> Iterator:
    """The same batches; after the last one the worker process, which Spark keeps for later tasks, gives memory back."""
    try:
        yield from batches
    finally:
        give_back()


def slices(column: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, starts)`` of bounded parts; ``starts`` has one entry more than rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(n, max(first + 1, end))
        starts = offsets[first : end + 1] - offsets[first]
        yield first, end, data[offsets[first] : offsets[end]], starts
        first = end


def words(
    data: np.ndarray, starts: np.ndarray, gap: np.ndarray = _SPACE, heads: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of every word, in text order; ``gap`` flags the bytes between words.

    For each size in ``heads`` follow the first so many bytes of all longer words, as words that no
    whole word equals.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = _LOWER[data]
    inside = ~gap[low]
    first = np.zeros(n + 1, dtype=bool)
    first[starts] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:n]
    at, to = np.flatnonzero(begins), np.flatnonzero(ends)
    rows = np.searchsorted(starts, at, "right") - 1
    longer = [to - at + 1 > size for size in heads]
    wanted = [(at, to)] + [(at[more], at[more] + (size - 1)) for more, size in zip(longer, heads)]
    found = [np.zeros(len(begin), np.uint64) for begin, _ in wanted]
    for (prime, _), letters, (power, inverse) in zip(_FIELDS, _LETTERS, _powers_to(n)):
        modulus = np.uint64(prime)
        terms = letters[low]
        terms *= power[:n]
        terms %= modulus
        sums = np.cumsum(terms)
        for i, (begin, end) in enumerate(wanted):
            value = (sums[end] - sums[begin] + terms[begin]) % modulus * inverse[begin] % modulus
            found[i] = found[i] << np.uint64(32) | value
    found[0] = mix(found[0] + (to - at + 1).astype(np.uint64) * np.uint64(_STEP))
    for i, size in enumerate(heads, 1):
        found[i] = mix(found[i] + np.uint64((size * _BASE) & 0xFFFFFFFFFFFFFFFF))
    return np.concatenate(found), np.concatenate([rows, *[rows[more] for more in longer]])


def _chain(parts) -> np.ndarray:
    out = None
    for part in parts:
        out = part if out is None else mix(out * np.uint64(_BASE) + part)
    return out


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of all runs of ``k`` words; a row with fewer words gives all of them as one run."""
    count = np.bincount(rows, minlength=n_rows)
    size = len(hashes) - k + 1
    if size > 0:
        whole = rows[: size] == rows[k - 1 :]
        made = _chain(hashes[i : i + size] for i in range(k))[whole]
        made = mix(made + np.uint64(k))
        owner = rows[: size][whole]
    else:
        made, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        begin = np.concatenate(([0], np.cumsum(count)))
        extra = np.array(
            [mix(_chain(hashes[begin[r] + i : begin[r] + i + 1] for i in range(count[r])) + np.uint64(count[r]))[0] for r in short],
            dtype=np.uint64,
        )
        made, owner = np.concatenate((made, extra)), np.concatenate((owner, short))
    return made, owner


def distinct(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of each row, ordered by row and value."""
    if np.any(rows[1:] < rows[:-1]):
        order = np.argsort(rows, kind="stable")
        values, rows = values[order], rows[order]
    else:
        values = values.copy()
    cuts = np.flatnonzero(rows[1:] != rows[:-1]) + 1
    for part in np.split(values, cuts):
        part.sort()
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[keep], rows[keep]


def sets_of(data: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle sets: ``(values, bounds, sizes)``; row r holds ``values[bounds[r]:bounds[r + 1]]``, sorted."""
    n_rows = len(starts) - 1
    values, rows = distinct(*shingles(*words(data, starts), n_rows, k))
    sizes = np.bincount(rows, minlength=n_rows)
    return values, np.concatenate(([0], np.cumsum(sizes))), sizes
