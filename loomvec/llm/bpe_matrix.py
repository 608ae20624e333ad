"""Byte-level BPE on padded numpy matrices.

Texts are split by the tokenizer's pattern; every different piece is encoded once per
task and remembered within a bound. New pieces are grouped by length into padded matrices,
one piece a row. In each round every row merges its leftmost pair of minimum rank;
pairs are looked up in a hash table of numpy arrays, merged cells close up, and finished
rows leave the matrix. A piece that is a token of its own keeps that token.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomvec.llm.wordarrays import returning, short_batches

_NONE = np.int32(2**31 - 1)
_PAD = np.int32(-1)
# Cells of one matrix, and pieces remembered per task: bounds on memory only.
CELLS = 1 << 18
REMEMBERED = 600_000
SLICE_CHARS = 1 << 20


class PairTable:
    """Rank of every pair of tokens whose bytes together are a token: open addressing, linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(len(rank) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << bits, _NONE, dtype=np.int32)
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot, todo, self.probes = self._home(keys), np.arange(len(keys)), 1
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            self.keys[slot[free]] = keys[free]  # of several, the last one stays
            self.ranks[slot[free]] = rank[free]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask
            self.probes += bool(len(todo))

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        shape = left.shape
        keys = ((left.astype(np.int64) << 32) | right.astype(np.int64)).ravel()
        out = np.full(len(keys), _NONE, dtype=np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._home(keys[todo])
        for _ in range(self.probes):
            held = self.keys[slot]
            hit = held == keys[todo]
            out[todo[hit]] = self.ranks[slot[hit]]
            go = ~hit & (held != -1)
            if not go.any():
                break
            todo, slot = todo[go], (slot[go] + 1) & self.mask
        return out.reshape(shape)


class Tokenizer:
    """Encodes texts to the ids of a rank file, and back."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        # White space as the property alone: without the control characters 0x1C to 0x1F.
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        pairs = [
            (ranks[token[:cut]], ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        self.pairs = PairTable(*np.array(pairs, dtype=np.int64).reshape(-1, 3).T.astype(np.int32))
        self.known: dict[str, bytes] = {}

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        pieces = [self.split(text) for text in texts]
        known = self.known
        new = {p for row in pieces for p in row if p not in known}
        if new:
            self._learn(list(new))
        return [b"".join([known[p] for p in row]) for row in pieces]

    def decode_ids(self, ids: bytes) -> bytes:
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])

    def _learn(self, pieces: list[str]) -> None:
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.known[piece] = rank.to_bytes(4, "little")
            else:
                by_width.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append((piece, raw))
        for width, group in by_width.items():
            step = max(1, CELLS // width)
            for at in range(0, len(group), step):
                part = group[at : at + step]
                for (piece, _), ids in zip(part, self._merge_rows([raw for _, raw in part], width)):
                    self.known[piece] = ids

    def _merge_rows(self, rows: list[bytes], width: int) -> list[bytes]:
        n = len(rows)
        size = np.array([len(raw) for raw in rows])
        ids = np.full((n, width), _PAD, dtype=np.int32)
        inside = np.arange(width) < size[:, None]
        ids[inside] = self.byte[np.frombuffer(b"".join(rows), dtype=np.uint8)]
        rank = self.pairs.look_up(ids[:, :-1], ids[:, 1:])
        done: list[bytes | None] = [None] * n
        left = np.arange(n)
        while len(left):
            at = rank.argmin(axis=1)
            every = np.arange(len(left))
            best = rank[every, at]
            over = best == _NONE
            if over.any():
                held = ids[over] >= 0
                flat = ids[over][held].astype("<u4").tobytes()
                ends = (4 * np.cumsum(held.sum(axis=1))).tolist()
                for i, begin, end in zip(left[over].tolist(), [0, *ends], ends):
                    done[i] = flat[begin:end]
                go = ~over
                ids, rank, left, at, best, every = ids[go], rank[go], left[go], at[go], best[go], np.arange(int(go.sum()))
                if not len(left):
                    break
                # Rows have grown shorter: drop columns no row needs any more.
                used = max(2, int((ids >= 0).sum(axis=1).max()))
                ids, rank = ids[:, :used], rank[:, : used - 1]
            if ids.shape[1] >= 1024 and self._merge_all(ids, rank, best):
                continue
            ids[every, at] = best
            later = np.arange(1, ids.shape[1]) > at[:, None]
            ids[:, 1:][later] = np.concatenate((ids[:, 2:], np.full((len(left), 1), _PAD, np.int32)), axis=1)[later]
            shifted = np.concatenate((rank[:, 1:], np.full((len(left), 1), _NONE, np.int32)), axis=1)
            later = np.arange(rank.shape[1]) > at[:, None]
            rank = np.where(later, shifted, rank)
            nxt = np.minimum(at + 1, ids.shape[1] - 1)
            rank[every, np.minimum(at, rank.shape[1] - 1)] = np.where(
                at + 1 < ids.shape[1], self.pairs.look_up(ids[every, at], ids[every, nxt]), _NONE
            )
            before = np.flatnonzero(at > 0)
            rank[before, at[before] - 1] = self.pairs.look_up(ids[before, at[before] - 1], ids[before, at[before]])
        return done

    def _merge_all(self, ids: np.ndarray, rank: np.ndarray, best: np.ndarray) -> bool:
        """For very long rows: all of a row's minimum-rank pairs from the left in one round.

        Same result as one merge a round, unless a merge makes a pair of still lower rank; then
        nothing is changed and False is returned.
        """
        new_ids, new_rank = np.full_like(ids, _PAD), np.full_like(rank, _NONE)
        for r in range(len(ids)):
            row = ids[r][ids[r] >= 0]
            hit = np.flatnonzero(rank[r][: len(row) - 1] == best[r])
            # Of a run of overlapping pairs, every second one from its start.
            run = np.concatenate(([0], np.cumsum(np.diff(hit) != 1)))
            begin = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1))
            take = hit[(np.arange(len(hit)) - begin[run]) % 2 == 0]
            row = row.copy()
            row[take] = best[r]
            row = np.delete(row, take + 1)
            made = self.pairs.look_up(row[:-1], row[1:])
            if len(made) and made.min() < best[r]:
                return False
            new_ids[r, : len(row)] = row
            new_rank[r, : len(row) - 1] = made
        ids[:], rank[:] = new_ids, new_rank
        return True


def _tokenizer(path: str, pattern: str) -> Tokenizer:
    """One tokenizer per worker process: functions arrive anew with every task, modules stay."""
    held = vars(sys.modules.setdefault("_loaded_tokenizers", types.ModuleType("_loaded_tokenizers")))
    key = f"{path}\n{pattern}"
    if key not in held:
        held[key] = Tokenizer(path, pattern)
    return held[key]


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str, decode: bool) -> Iterator[pa.RecordBatch]:
    tokenizer = _tokenizer(path, pattern)
    for batch in batches:
        keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
        first = 0
        while first < len(texts):
            end, chars = first, 0
            while end < len(texts) and (end == first or chars + len(texts[end]) <= SLICE_CHARS):
                chars += len(texts[end])
                end += 1
            ids = tokenizer.encode_texts(texts[first:end])
            out = [keys.slice(first, end - first), pa.array(ids, pa.binary())]
            if decode:
                out.append(pa.array([tokenizer.decode_ids(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "ids", "decoded"][: len(out)])
            first = end


def encode_documents(
    docs: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    decode: bool = False,
) -> DataFrame:
    """``(doc_id, ids binary[, decoded binary])``: one row per row of ``docs (doc_id, text, ...)``.

    ``ids`` are the token ids as little-endian unsigned 32-bit integers, ``decoded`` the bytes
    they stand for. Null and empty texts have no ids. Null and repeated doc_ids pass through;
    rows are independent, so ties cannot occur; other columns of any name are ignored. Special
    tokens in a text are ordinary text. The rank file has to be at ``path`` on every worker.
    """
    short_batches(docs.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    schema = "doc_id long, ids binary" + (", decoded binary" if decode else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: returning(_encode(batches, path, pattern, decode)), schema)


def token_count(ids: str = "ids"):
    return (F.octet_length(ids) / 4).cast("long")
