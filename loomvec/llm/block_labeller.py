"""Main text of pages by a recurrent block labeller.

A page is a sequence of leaf blocks. Each block becomes a vector: the sum of embeddings of the names on its tag path, the mean of embeddings of its
hashed words, and a few numbers (length, share of linked text, place in the page). A bidirectional LSTM in numpy reads the
sequence, so that the label of every block may depend on the whole page, and a logistic layer tells main text
from the rest. The model learns from composed pages (``page_layouts``), whose main text is known; no row of a table is learned.

Pages are labelled in batches of like block counts, padded and masked. Padding never reaches a page's own states,
and all blocks and words of a page take part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomvec.llm import wordarrays as wa
from loomvec.llm.html_blocks import Block, blocks_of
from loomvec.llm.page_layouts import Composer

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class Settings:
    """``pages`` composed pages are learned from; ``cells`` bounds the padded blocks of one batch."""

    pages: int = 2400
    epochs: int = 4
    batch: int = 32
    names: int = 2048
    words: int = 8192
    name_size: int = 16
    word_size: int = 8
    hidden: int = 24
    rate: float = 0.01
    cells: int = 1 << 14
    seed: int = 17


NUMBERS = 6


@dataclass
class Sequences:
    """Features of the blocks of some pages; ``ends`` is where each page's blocks end."""

    names: np.ndarray
    name_of: np.ndarray
    words: np.ndarray
    word_of: np.ndarray
    numbers: np.ndarray
    ends: np.ndarray


def _bucket(raw: bytes, size: int) -> int:
    return zlib.crc32(raw) % size


def features(pages: list[list[Block]], settings: Settings) -> Sequences:
    """Hashed names and words of all blocks, and their numbers."""
    names, name_count, words, word_count, numbers, ends = [], [], [], [], [], []
    paths: dict[tuple, list[int]] = {}
    crc, buckets = zlib.crc32, settings.words
    for blocks in pages:
        total = len(blocks)
        for at, block in enumerate(blocks):
            key = (block.path, block.tag)
            found = paths.get(key)
            if found is None:
                found = paths[key] = [_bucket(n.encode(), settings.names) for n in sorted(block.path)] + [_bucket(f">{block.tag}".encode(), settings.names)]
            names += found
            name_count.append(len(found))
            split = block.text.encode("utf-8", "replace").translate(_LOWER).split()
            words += [crc(w) % buckets for w in split]
            word_count.append(len(split))
            size = len(block.text)
            numbers.append((
                np.log1p(size) / 5, np.log1p(len(split)) / 4, block.linked / size, at / total, 1 / (1 + at), 1 / (total - at),
            ))
        ends.append(len(name_count))
    count = len(name_count)
    return Sequences(
        np.array(names, np.int64), np.repeat(np.arange(count), name_count), np.array(words, np.int64), np.repeat(np.arange(count), word_count),
        np.array(numbers, np.float32).reshape(count, NUMBERS), np.array(ends, np.int64),
    )


def _sums(table: np.ndarray, buckets: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Sum of the embeddings of each owner's buckets."""
    sums = np.zeros((count, table.shape[1]), np.float32)
    for at in range(0, len(buckets), 1 << 17):
        mine, of = buckets[at : at + (1 << 17)], owner[at : at + (1 << 17)]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        sums[of[first]] += np.add.reduceat(table[mine], first, axis=0)
    return sums


def joined(parts: list[Sequences]) -> Sequences:
    """The features of several lots of pages as one."""
    moved = np.cumsum([0] + [len(s.numbers) for s in parts])
    return Sequences(
        np.concatenate([s.names for s in parts]), np.concatenate([s.name_of + m for s, m in zip(parts, moved)]),
        np.concatenate([s.words for s in parts]), np.concatenate([s.word_of + m for s, m in zip(parts, moved)]),
        np.concatenate([s.numbers for s in parts]), np.concatenate([s.ends + m for s, m in zip(parts, moved)]),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _run(x: np.ndarray, mask: np.ndarray, recurrent: np.ndarray, keep: bool, start=None):
    """Hidden states (time, page, hidden) of one direction; masked steps carry the state on.

    ``x`` has the input's share of the gates; with the states comes the tape for training, or else where a next part goes on.
    """
    steps, pages, width = x.shape
    hidden = width // 4
    h, c = start or (np.zeros((pages, hidden), np.float32), np.zeros((pages, hidden), np.float32))
    states = np.zeros((steps, pages, hidden), np.float32)
    tape = []
    for t in range(steps):
        gates = x[t] + h @ recurrent
        open_, write, read = (_sigmoid(gates[:, i * hidden : (i + 1) * hidden]) for i in range(3))
        new = np.tanh(gates[:, 3 * hidden :])
        m = mask[t][:, None]
        cell = open_ * c + write * new
        bent = np.tanh(cell)
        if keep:
            tape.append((open_, write, read, new, c, bent, h))
        h = m * (read * bent) + (1 - m) * h
        c = m * cell + (1 - m) * c
        states[t] = h
    return states, tape if keep else (h, c)


def _run_back(grown: np.ndarray, mask: np.ndarray, recurrent: np.ndarray, tape: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates' inputs and of the recurrent matrix, from those of the states."""
    steps, pages, hidden = grown.shape
    dx = np.zeros((steps, pages, 4 * hidden), np.float32)
    dw = np.zeros_like(recurrent)
    dh, dc = np.zeros((pages, hidden), np.float32), np.zeros((pages, hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        open_, write, read, new, before, bent, h = tape[t]
        m = mask[t][:, None]
        dh = dh + grown[t]
        out = m * dh
        cell = m * dc + out * read * (1 - bent**2)
        gates = np.concatenate((
            cell * before * open_ * (1 - open_), cell * new * write * (1 - write), out * bent * read * (1 - read), cell * write * (1 - new**2),
        ), axis=1)
        dx[t] = gates
        dw += h.T @ gates
        dh = gates @ recurrent.T + (1 - m) * dh
        dc = cell * open_ + (1 - m) * dc
    return dx, dw


@dataclass
class Model:
    """Embeddings, gates of both directions, and the logistic layer."""

    weights: dict[str, np.ndarray]
    settings: Settings

    def vectors(self, s: Sequences) -> tuple[np.ndarray, np.ndarray]:
        """A row per block, and one over its number of words."""
        count = len(s.numbers)
        names = _sums(self.weights["names"], s.names, s.name_of, count)
        share = 1 / np.maximum(np.bincount(s.word_of, minlength=count), 1).astype(np.float32)
        words = _sums(self.weights["words"], s.words, s.word_of, count) * share[:, None]
        return np.concatenate((names, words, s.numbers, np.ones((count, 1), np.float32)), axis=1), share

    def scores(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """The probability of being main text, for every block of every page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end, longest = at, 1
            while end < len(order) and (end == at or max(longest, len(pages[order[end]])) * (end - at + 1) <= self.settings.cells):
                longest = max(longest, len(pages[order[end]]))
                end += 1
            some = order[at:end]
            at = end
            s = features([pages[i] for i in some], self.settings)
            if not len(s.numbers):
                continue
            x, _ = self.vectors(s)
            place, mask = _places(s.ends)
            z = np.full(mask.shape, self.weights["bias"][0], np.float32)
            for side in "fb":
                turn, on = 1 if side == "f" else -1, None
                own, shown, made = place[::turn], mask[::turn].astype(np.float32), z[::turn]
                # Long pages go through in parts, which bounds the gates held at once.
                part = max(1, self.settings.cells // len(some))
                for t in range(0, len(own), part):
                    gates = x[own[t : t + part]] @ self.weights["in" + side]
                    states, on = _run(gates, shown[t : t + part], self.weights["re" + side], False, on)
                    made[t : t + part] += states @ self.weights["out" + side]
            p = _sigmoid(z)
            for k, i in enumerate(some):
                out[i] = p[: len(pages[i]), k]
        return out


def _places(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block numbers by (step, page), 0 where a page is over, and where it is not."""
    begins = np.concatenate(([0], ends[:-1]))
    steps = np.arange(max(1, int((ends - begins).max())))[:, None]
    mask = steps < (ends - begins)
    return np.where(mask, steps + begins, 0), mask


def _fresh(settings: Settings) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(settings.seed)
    h, width = settings.hidden, settings.name_size + settings.word_size + NUMBERS + 1
    draw = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
    weights = {"names": draw(settings.names, settings.name_size, scale=0.15), "words": draw(settings.words, settings.word_size, scale=0.1)}
    for side in "fb":
        weights["in" + side] = draw(width, 4 * h, scale=width**-0.5)
        weights["in" + side][-1, :h] += 1  # remember at first
        weights["re" + side] = draw(h, 4 * h, scale=h**-0.5)
        weights["out" + side] = draw(h, scale=h**-0.5)
    weights["bias"] = np.zeros(1, np.float32)
    return weights


def _gradients(model: Model, s: Sequences, labels: np.ndarray) -> dict[str, np.ndarray]:
    w, settings = model.weights, model.settings
    x, share = model.vectors(s)
    place, mask = _places(s.ends)
    shown = mask.astype(np.float32)
    z, kept = np.full(mask.shape, w["bias"][0], np.float32), {}
    for side in "fb":
        turn = 1 if side == "f" else -1
        states, tape = _run((x @ w["in" + side])[place[::turn]], shown[::turn], w["re" + side], keep=True)
        kept[side] = states, tape
        z += states[::turn] @ w["out" + side]
    error = (_sigmoid(z) - labels[place]) * shown / shown.sum()
    made = {"bias": np.array([error.sum()], np.float32)}
    dx = np.zeros_like(x)
    for side in "fb":
        turn = 1 if side == "f" else -1
        states, tape = kept[side]
        mine = error[::turn]
        made["out" + side] = np.tensordot(mine, states, axes=([0, 1], [0, 1]))
        gates, made["re" + side] = _run_back(mine[:, :, None] * w["out" + side], shown[::turn], w["re" + side], tape)
        own = place[::turn][mask[::turn]]
        flat = gates[mask[::turn]]
        made["in" + side] = x[own].T @ flat
        dx[own] += flat @ w["in" + side].T
    n, width = settings.name_size, settings.name_size + settings.word_size
    for name, buckets, each in (
        ("names", s.names, dx[s.name_of, :n]), ("words", s.words, (dx[:, n:width] * share[:, None])[s.word_of]),
    ):
        made[name] = np.stack([np.bincount(buckets, each[:, i], len(w[name])) for i in range(each.shape[1])], axis=1).astype(np.float32)
    return made


def composed(n: int, seed: int) -> tuple[list[list[Block]], list[np.ndarray]]:
    """``n`` composed pages as blocks, with 1 for main text."""
    composer, pages, labels = Composer(seed), [], []
    for _ in range(n):
        page, kept = composer.page()
        blocks = blocks_of(page)
        pages.append(blocks)
        labels.append(np.array([block.text in kept for block in blocks], np.float32))
    return pages, labels


@lru_cache(maxsize=2)
def fit(settings: Settings = Settings()) -> Model:
    """Train by Adam on composed pages. The same settings always give the same model."""
    rng = np.random.default_rng(settings.seed)
    pages, labels = composed(settings.pages, settings.seed)
    read = [features([p], settings) for p in pages]
    model = Model(_fresh(settings), settings)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step, steps = 0, settings.epochs * -(-len(pages) // settings.batch)
    for _ in range(settings.epochs):
        # Batches of pages of like length, in random order.
        order = np.argsort([len(p) + rng.uniform(0, 8) for p in pages])
        starts = np.arange(0, len(order), settings.batch)
        for at in rng.permutation(starts).tolist():
            some = order[at : at + settings.batch]
            gradients = _gradients(model, joined([read[i] for i in some]), np.concatenate([labels[i] for i in some]))
            norm = float(np.sqrt(sum((g**2).sum() for g in gradients.values())))
            step += 1
            rate = settings.rate * min(1, step / 20) * (1 - 0.9 * step / steps)
            for k, g in gradients.items():
                g = g / max(1.0, norm)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                model.weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def main_texts(pages: list[str | None], model: Model) -> list[str]:
    """The main text of each page: its main blocks in order, one a line."""
    read = [blocks_of(page) for page in pages]
    return ["\n".join(b.text for b, p in zip(blocks, score) if p >= 0.5) for blocks, score in zip(read, model.scores(read))]


def _extract(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(batch.num_columns - 1).cast(pa.large_string())
        size = column.buffers()[1] if len(column) else None
        offsets = np.frombuffer(size, np.int64)[column.offset : column.offset + len(column) + 1] if size else np.zeros(1, np.int64)
        texts: list[str] = []
        first = 0
        while first < len(column):
            # About a megabyte of pages at a time; one longer page by itself.
            end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + wa.SLICE_BYTES, "right")) - 1)
            texts += main_texts(column.slice(first, end - first).to_pylist(), model)
            first = end
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=[str(i) for i in range(batch.num_columns + 1)],
        )


def extract_main_text(pages: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Add ``text string, n_chars long`` to the ``keep`` columns (all, if None) of ``pages``.

    The whole ``html`` of every row is read. Null and empty pages, and pages without a main block, get an empty text. Equal
    pages may differ only by rounding in the last place of a score, never by their neighbours' content. Null and repeated ids pass through;
    columns of ``pages`` with the names of new ones are replaced; an empty table gives none.
    """
    wa.short_batches(pages.sparkSession)
    keep = [c for c in (keep or pages.columns) if c not in ("text", "n_chars")]
    own = pages.select(*[F.col(f"`{c}`") for c in keep])
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col("html").cast("string").alias("_html"))
    schema = own.schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(lambda batches: _extract(batches, model), schema)
