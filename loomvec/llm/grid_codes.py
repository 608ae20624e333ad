"""Vector codes by k-means over parts, with memoised grid cells.

A vector is cut into equal parts, and each part position has a codebook of a few integer entries.
To assign a part, its components are cut down to a coarse grid cell. The first part seen in a cell
works out which entries can be nearest anywhere in the cell's box: one is left out if its smallest
distance to the box is above some other entry's largest distance. A memo keeps that answer under
the cell's hash, and all parts in the cell are compared exactly with the remaining entries only.

All arithmetic is on integers, so results do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomvec.llm.vectors import matrix, scaled
from loomvec.session import materialise


@dataclass(frozen=True)
class Settings:
    """``cell`` is the edge of a grid cell; a memo starts anew once it holds ``most_cells``."""

    scale: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    cell: int = 512
    most_cells: int = 50_000


#: By length of vector and part position, the entries as rows.
Codebooks = dict[int, list[np.ndarray]]


def bounds(length: int, parts: int) -> list[int]:
    """Where parts begin and end; parts differ by at most one component if ``parts`` does not divide the length."""
    return [length * i // parts for i in range(parts + 1)]


class Memo:
    """Entries that may be nearest, by grid cell, for one codebook."""

    def __init__(self, book: np.ndarray, cell: int, most: int):
        self.book, self.cell, self.most = book.astype(np.int64), cell, most
        self.odd = np.random.default_rng(book.shape[1]).integers(0, 2**63, book.shape[1], dtype=np.uint64) | np.uint64(1)
        self.evaluated = 0
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.cells = np.zeros((0, self.book.shape[1]), np.int64)
        self.open = np.zeros((0, len(self.book)), bool)

    def _undominated(self, cells: np.ndarray) -> np.ndarray:
        """Per cell which entries are not farther everywhere in its box than some other entry."""
        low = (cells * self.cell)[:, None, :]
        high = low + self.cell - 1
        over, under = low - self.book, self.book - high
        nearest = np.maximum(np.maximum(over, under), 0)
        farthest = np.maximum(high - self.book, self.book - low)
        return (nearest**2).sum(axis=2) <= (farthest**2).sum(axis=2).min(axis=1)[:, None]

    def _open_entries(self, cells: np.ndarray) -> np.ndarray:
        mixed = (cells.astype(np.uint64) * self.odd).sum(axis=1, dtype=np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        keys, first, which = np.unique(mixed, return_index=True, return_inverse=True)
        if len(self.slot) > self.most:
            self._clear()
        listed = keys.tolist()
        new = [i for i, key in enumerate(listed) if key not in self.slot]
        if new:
            self.slot.update((listed[i], len(self.cells) + n) for n, i in enumerate(new))
            made = cells[first[new]]
            self.cells = np.concatenate((self.cells, made))
            chunks = [self._undominated(made[at : at + 4096]) for at in range(0, len(made), 4096)]
            self.open = np.concatenate((self.open, *chunks))
        slots = np.array([self.slot[key] for key in listed], dtype=np.int64)[which]
        # Two cells of one hash: the second one is compared with all entries.
        return self.open[slots] | (self.cells[slots] != cells).any(axis=1)[:, None]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(entry, squared distance)`` of every part; ties go to the lower entry."""
        allowed = self._open_entries(parts // self.cell)
        self.evaluated += int(allowed.sum())
        entry = np.zeros(len(parts), np.int64)
        best = np.full(len(parts), np.iinfo(np.int64).max)
        for e in range(len(self.book)):
            at = np.flatnonzero(allowed[:, e])
            far = ((parts[at] - self.book[e]) ** 2).sum(axis=1)
            nearer = far < best[at]
            best[at[nearer]], entry[at[nearer]] = far[nearer], e
        return entry, best


def _memos(books: Codebooks, settings: Settings) -> dict[int, list[Memo]]:
    return {n: [Memo(b, settings.cell, settings.most_cells) for b in book] for n, book in books.items()}


def _by_length(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, rows, matrix)`` of the vectors in column ``at``, for each length."""
    lengths = batch.column(at).value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        yield n, rows, matrix(batch.column(at).take(pa.array(rows))).astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch], books: Codebooks, settings: Settings) -> Iterator[pa.RecordBatch]:
    """Counts and component sums of all entries over a task's rows."""
    memos = _memos(books, settings)
    count = {n: [np.zeros(len(b), np.int64) for b in book] for n, book in books.items()}
    total = {n: [np.zeros(b.shape, np.int64) for b in book] for n, book in books.items()}
    for batch in batches:
        for n, _, values in _by_length(batch, 0):
            cut = bounds(n, settings.parts)
            for p in range(settings.parts):
                part = values[:, cut[p] : cut[p + 1]]
                entry, _ = memos[n][p].nearest(part)
                count[n][p] += np.bincount(entry, minlength=len(count[n][p]))
                np.add.at(total[n][p], entry, part)
    rows = [
        (n, p, e, int(count[n][p][e]), total[n][p][e].tolist())
        for n, book in books.items() for p, b in enumerate(book) for e in range(len(b)) if count[n][p][e]
    ]
    names = ["length", "part", "entry", "n", "sums"]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _codes(batches: Iterator[pa.RecordBatch], books: Codebooks, settings: Settings) -> Iterator[pa.RecordBatch]:
    memos = _memos(books, settings)
    digest = {n: digest_of(book) for n, book in books.items()}
    for batch in batches:
        codes, errors, digests = [""] * batch.num_rows, np.zeros(batch.num_rows, np.int64), [""] * batch.num_rows
        for n, rows, values in _by_length(batch, 2):
            cut = bounds(n, settings.parts)
            picked = np.zeros((len(rows), settings.parts), np.uint8)
            for p in range(settings.parts):
                entry, far = memos[n][p].nearest(values[:, cut[p] : cut[p + 1]])
                picked[:, p] = entry
                errors[rows] += far
            for row, code in zip(rows.tolist(), picked):
                codes[row], digests[row] = code.tobytes().hex(), digest[n]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(codes, pa.string()), pa.array(errors), pa.array(digests, pa.string())],
            names=["vec_id", "label", "code", "error", "codebooks_sha256"],
        )


def digest_of(book: list[np.ndarray]) -> str:
    """SHA-256 of the entries' decimal components, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for part in book for x in part.ravel().tolist()).encode()).hexdigest()


def _first_books(rows: DataFrame, settings: Settings) -> Codebooks:
    order = Window.partitionBy(F.size("v")).orderBy(F.asc_nulls_last("vec_id"), "v")
    first = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= settings.entries)
    books: dict[int, list[list[int]]] = {}
    for row in first.select(F.size("v").alias("length"), "at", "v").orderBy("length", "at").collect():
        books.setdefault(row["length"], []).append(row["v"])
    cuts = {n: bounds(n, settings.parts) for n in books}
    return {
        n: [np.array([v[cuts[n][p] : cuts[n][p + 1]] for v in held], np.int64).reshape(len(held), -1) for p in range(settings.parts)]
        for n, held in books.items()
    }


def learn(rows: DataFrame, settings: Settings = Settings()) -> Codebooks:
    """Codebooks of ``rows`` (``v array<int>``); tasks send one row per used entry, which are added up before the driver sees them."""
    books = _first_books(rows, settings)
    schema = "length int, part int, entry int, n long, sums array<long>"
    for _ in range(settings.rounds if books else 0):
        now = {n: [b.copy() for b in book] for n, book in books.items()}
        made = rows.select("v").mapInArrow(lambda batches: _sums(batches, now, settings), schema)
        keys = ["length", "part", "entry"]
        counted = made.select(*keys, "n", F.posexplode_outer("sums").alias("at", "x"))
        added = counted.groupBy(*keys, "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        for row in added.where("at is not null").collect():
            books[row["length"]][row["part"]][row["entry"], row["at"]] = row["x"] // row["n"]
    return books


def encode(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(vec_id, label, code, error, label_error, codebooks_sha256)`` of every row with a whole vector.

    Rows whose vector is null or holds null or non-finite components are left out. Null and repeated vec_ids are rows like
    others; the entries a codebook starts from are those of the smallest vec_ids, nulls last, equal ids by their vectors.
    Each length of vector has codebooks of its own, and an empty vector an empty code's distance of 0. With fewer rows than
    entries there are fewer entries. An empty table gives no rows; other columns are ignored. A component beyond
    +-2**27 / scale is an error.
    """
    rows = materialise(scaled(vectors, settings.scale), "scaled")
    books = learn(rows, settings)
    schema = "vec_id long, label long, code string, error long, codebooks_sha256 string"
    coded = rows.select("vec_id", "label", "v").mapInArrow(lambda batches: _codes(batches, books, settings), schema)
    coded = materialise(coded, "codes")
    by_label = materialise(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label_errors")
    whole = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return whole.select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")
