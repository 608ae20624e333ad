"""Exact set-similarity clusters of texts through PartEnum signatures.

A text is the set of its distinct word shingles. Sets are put into bands of nearly equal
size. Two sets of similarity ``gamma`` or more differ in at most K elements, where K
follows from their sizes. Within a band the element domain is dealt into P partitions by
hash, and subsets of ``g`` partitions are enumerated: sets that differ in at most K
elements agree completely on at least P - K partitions, hence on some subset. Each agreed
subset is one equal signature, so no similar pair is lost.

* Tiny sets (K of 1 or 2) use P = K + 2 partitions and all subsets of two of them. Larger
  ones use subsets of a single partition; a set then needs only its first K + 1 partitions
  that hold an element: before the first non-empty agreed partition at most K of them differ.
* A set whose elements meet too few partitions to be sure emits signatures under the next
  seed as well, and after the last one also the empty subset; the set of a pair that succeeds
  first fixes the seed both share.
* Elements in very many texts (shared passages) stay out of the first seed's domain. Leaving
  elements out never adds differences, so this is exact too; which elements are left out
  only steers the cost.

Candidates are never listed pair by pair. Every signature group first compares its members
with one leader (rounds of verified links, linear in the group). Only groups that still hold
several components are compared on, in bounded blocks of members, and blocks return
links that join components.

Before the texts of a candidate pair are brought together, a parity bitmap of each set rules out what it can: every
shingle toggles one bit, so the bitmaps of two sets differ in at most as many bits as the sets differ in elements. A pair
whose bitmaps differ in more bits than links allow is dropped; no link is lost. Large groups meet in blocks of bitmaps
first, which leave small clusters of sets that may be linked; texts are fetched only for what is left, never for all members
of groups. Texts that share a passage and no more would otherwise be copied to every block of all texts with that passage.

What is shuffled for signatures and texts is a multiple of the input where most texts have near copies. Steps that do so
go over their input in slices of signatures, pairs or components, one after another, so that only one slice is on disk.

Links are counted afterwards: every link lies inside one component, so all pairs of a component's
different sets are compared once, in bounded blocks, and blocks return a count per set. A set is
sent as its difference from one set of its component, which says as much and is short for near copies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomvec.llm import wordarrays as wa
from loomvec.llm.bitmaps import bitmap_of, may_hold
from loomvec.llm.components import components
from loomvec.session import discard, materialise

SEEDS = 4
# Texts, and their bytes, on either side of one group of the block step.
BLOCK = 2048
BLOCK_BYTES = 8 << 20
# Bitmaps, and their bytes, on either side of one group of the step before it.
SIFTED = 8192
SIFTED_BYTES = 4 << 20
# Sets on either side of one group of the counting step, and the bytes of their differences.
COUNTED = 1024
COUNTED_BYTES = 4 << 20
# Largest open group whose members are compared pair by pair; larger ones go to the block step.
PAIRWISE = 16
# Leader rounds before these two.
ROUNDS = 2
# Signatures of one slice, and the most slices of a step.
SLICE_ROWS = 1 << 24
MOST_SLICES = 8
# Pairs whose texts are together at a time: at least so many, and this share of the texts.
SLICE_PAIRS = 20_000
# A shingle is frequent if it is in more than this share of the texts, by a summary per task.
FREQUENT_SHARE = 0.002
FREQUENT_AT_LEAST = 40
_U = np.uint64


@dataclass(frozen=True)
class Similarity:
    """Jaccard of at least ``percent / 100`` over shingles of ``words`` words."""

    words: int = 5
    percent: int = 80

    def most_different(self, sizes: np.ndarray) -> np.ndarray:
        """Largest symmetric difference of linked sets whose sizes add up to ``sizes``."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def tops(self, largest: int) -> np.ndarray:
        """Upper ends of the size bands."""
        ratio = max(1.5, 100 / self.percent)
        ends = [1]
        while ends[-1] < largest:
            ends.append(max(ends[-1] + 1, int(ends[-1] * ratio)))
        return np.array(ends, dtype=np.int64)

    def linked(self, shared, a, b):
        return 100 * shared >= self.percent * (a + b - shared)


def _partitions(most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(P, g)`` for bands with differences up to ``most``."""
    subset = np.where((most == 1) | (most == 2), 2, 1)
    spare = 2 + most * 6 // 100
    return np.where(most == 0, 1, np.where(subset == 2, most + 2, most + 1 + spare)), subset


def signatures(values: np.ndarray, bounds: np.ndarray, law: Similarity, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(signature, row)`` for all non-empty sets of a slice."""
    sizes = np.diff(bounds)
    if not len(values):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    # The largest set of the slice only bounds the table of bands; bands are the same everywhere.
    tops = law.tops(int(sizes.max()) * 100 // law.percent + 1)
    home = np.searchsorted(tops, sizes)
    reach = np.searchsorted(tops, sizes * 100 // law.percent)
    out_sig, out_row = [], []
    for ahead in range(int((reach - home).max()) + 1):
        row = np.flatnonzero((sizes > 0) & (reach >= home + ahead))
        band = home[row] + ahead
        for seed in range(SEEDS):
            if not len(row):
                break
            sig, owner, row, band = _one_seed(values, bounds, row, band, tops, law, seed, frequent if seed == 0 else None)
            out_sig.append(sig)
            out_row.append(owner)
    return np.concatenate(out_sig), np.concatenate(out_row)


def _one_seed(values, bounds, row, band, tops, law, seed, frequent):
    """Signatures of the given rows for one band each; also the rows that need another seed."""
    sizes = bounds[row + 1] - bounds[row]
    limit = np.minimum(sizes * 100 // law.percent, tops[band])
    most = law.most_different(sizes + limit)
    parts, subset = _partitions(law.most_different(2 * tops[band]))
    base = np.concatenate(([0], np.cumsum(parts)))
    # The elements of all rows in one run, with the row's place in ``row`` beside them.
    total = int(sizes.sum())
    place = np.repeat(np.arange(len(row)), sizes)
    ends = np.cumsum(sizes)
    element = values[np.arange(total) - np.repeat(ends - sizes - bounds[row], sizes)]
    if frequent is not None and len(frequent):
        at = np.minimum(np.searchsorted(frequent, element), len(frequent) - 1)
        rare = frequent[at] != element
        element, place = element[rare], place[rare]
    dealt = wa.mix(element ^ _U(0xA5A5A5A5 + 7919 * seed))
    part = ((dealt >> _U(32)) * parts[place].astype(_U)) >> _U(32)
    cell = base[place] + part.astype(np.int64)
    held = np.bincount(cell, minlength=base[-1]) > 0
    sums = np.zeros(base[-1], dtype=_U)
    np.add.at(sums, cell, wa.mix(element * _U(0xC2B2AE3D27D4EB4F) + _U(seed + 1)))
    owner = np.repeat(np.arange(len(row)), parts)
    number = np.arange(base[-1]) - base[owner]
    full = np.add.reduceat(held.astype(np.int64), base[:-1])
    last = seed == SEEDS - 1
    label = (band.astype(_U) << _U(8)) + _U(seed)
    # One partition a subset: the first K + 1 that hold an element.
    single = subset == 1
    rank = np.cumsum(held) - np.concatenate(([0], np.cumsum(full)))[owner]
    use = held & single[owner] & (rank <= most[owner] + 1)
    sig = [wa.mix(sums[use] + wa.mix((label[owner[use]] << _U(32)) + number[use].astype(_U)))]
    who = [owner[use]]
    sure = np.where(single, full >= most + 1, full >= parts - 1)
    # Two partitions a subset, for tiny sets.
    for p in np.unique(parts[~single]):
        own = np.flatnonzero(~single & (parts == p))
        for i, j in combinations(range(int(p)), 2):
            left, right = base[own] + i, base[own] + j
            some = (held[left] | held[right]) | last
            tag = wa.mix((label[own] << _U(32)) + _U(1 << 24) + _U(i * 64 + j))
            made = wa.mix(sums[left] + wa.mix(sums[right] + tag))
            sig.append(made[some])
            who.append(own[some])
    if last:
        unsure = np.flatnonzero(single & ~sure)
        sig.append(wa.mix((label[unsure] << _U(32)) + _U(1 << 25)))
        who.append(unsure)
    again = ~sure
    return np.concatenate(sig), row[np.concatenate(who)], row[again], band[again]


def fingerprint(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit value per set, equal for equal sets; 0 for the empty set."""
    sums = np.concatenate((np.zeros(1, _U), np.cumsum(wa.mix(values + _U(0x51ED27)), dtype=_U)))
    sizes = np.diff(bounds).astype(_U)
    made = wa.mix(sums[bounds[1:]] - sums[bounds[:-1]] + sizes * _U(0x9E3779B97F4A7C15))
    return np.where(sizes == 0, _U(0), np.maximum(made, _U(1)))


def parity_bitmaps(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Per set a bitmap in which each element toggles one bit: two to four bits an element, a power of two of them."""
    bits = 1 << np.ceil(np.log2(np.maximum(2 * sizes, 64))).astype(np.int64)
    ends = np.cumsum(bits)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = (wa.mix(values ^ _U(0x7A317E)) & (bits[owner] - 1).astype(_U)).astype(np.int64) + (ends - bits)[owner]
    packed = np.packbits(np.bincount(place, minlength=ends[-1] if len(ends) else 0).astype(np.uint8) & 1, bitorder="little").tobytes()
    return [packed[(end - n) // 8 : end // 8] for end, n in zip(ends.tolist(), bits.tolist())]


_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def bits_apart(a: bytes, b: bytes) -> int:
    """In how many bits two parity bitmaps differ; the longer one is folded to the length of the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) != len(y):
        n = min(len(x), len(y))
        x, y = (np.bitwise_xor.reduce(part.reshape(-1, n), axis=0) for part in (x, y))
    return int(_ONES[x ^ y].sum())


def _sift(batches: Iterator[pa.RecordBatch], law: Similarity) -> Iterator[pa.RecordBatch]:
    """Keep pairs that sizes and parity bitmaps do not rule out."""
    for batch in batches:
        a, b, size_a, size_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        keep = law.linked(np.minimum(size_a, size_b), size_a, size_b)
        most = law.most_different(size_a + size_b)
        for i in np.flatnonzero(keep).tolist():
            keep[i] = bits_apart(batch.column(4)[i].as_py(), batch.column(5)[i].as_py()) <= most[i]
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


def _sift_block(left, right, law: Similarity):
    """Pairs of two blocks that sizes and bitmaps do not rule out, no more than it takes to join the sets that such pairs join."""
    import pandas as pd

    found, links = [], _Links({*left["node"].tolist(), *right["node"].tolist()})
    others = list(zip(*(right[c].tolist() for c in ("node", "label", "size", "parity"))))
    for n, part in left.groupby(left["parity"].map(len)):
        part = part.sort_values("size", kind="stable")
        nodes, labels, sizes = (part[c].to_numpy() for c in ("node", "label", "size"))
        maps = {n: np.frombuffer(b"".join(part["parity"]), np.uint8).reshape(len(part), n)}
        low = np.searchsorted(sizes, [-(-law.percent * x[2] // 100) for x in others], "left").tolist()
        high = np.searchsorted(sizes, [100 * x[2] // law.percent for x in others], "right").tolist()
        for (node, label, size, parity), a, b in zip(others, low, high):
            if a >= b:
                continue
            short = min(n, len(parity))
            if short not in maps:
                maps[short] = np.bitwise_xor.reduce(maps[n].reshape(len(part), -1, short), axis=1)
            own = np.bitwise_xor.reduce(np.frombuffer(parity, np.uint8).reshape(-1, short), axis=0)
            apart = np.bitwise_count(maps[short][a:b].view(_U) ^ own.view(_U)).sum(axis=1, dtype=np.int64)
            near = (apart <= law.most_different(sizes[a:b] + size)) & (labels[a:b] != label)
            found += [(x, node) for x in nodes[a:b][near].tolist() if links.join(x, node)]
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _frequent_in(batches: Iterator[pa.RecordBatch], law: Similarity) -> Iterator[pa.RecordBatch]:
    """Shingles in many of a task's texts: counts of a bounded summary (lower bounds)."""
    keys, counts, texts = np.zeros(0, _U), np.zeros(0, np.int64), 0
    keep = int(2 / FREQUENT_SHARE) * 64
    for batch in batches:
        for _, _, data, starts in wa.slices(batch.column(0)):
            values, _, _ = wa.sets_of(data, starts, law.words)
            texts += len(starts) - 1
            found, n = np.unique(values, return_counts=True)
            many = n > 1
            keys, where = np.unique(np.concatenate((keys, found[many])), return_inverse=True)
            counts = np.bincount(where, np.concatenate((counts, n[many]))).astype(np.int64)
            if len(keys) > keep:
                top = np.sort(np.argpartition(counts, -keep)[-keep:])
                keys, counts = keys[top], counts[top]
    often = counts > max(FREQUENT_SHARE * texts, FREQUENT_AT_LEAST / 4)
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys[often].view(np.int64)), pa.array(counts[often])], names=["shingle", "texts"]
    )


def frequent_shingles(docs: DataFrame, law: Similarity) -> np.ndarray:
    """Sorted hashes of shingles in more than a small share of all texts.

    At most 1 / FREQUENT_SHARE times the longest text's shingles can pass, so the list is bounded
    whatever the corpus; it is cut at that bound by count, which changes cost only.
    """
    total = docs.count()
    found = docs.select("text").mapInArrow(lambda it: wa.returning(_frequent_in(it, law)), "shingle long, texts long")
    merged = found.groupBy("shingle").agg(F.sum("texts").alias("texts"))
    most = 1 << 17
    rows = (
        merged.where(F.col("texts") > max(FREQUENT_SHARE * total, FREQUENT_AT_LEAST))
        .orderBy(F.desc("texts"), "shingle").limit(most).select("shingle").toPandas()
    )
    return np.sort(rows["shingle"].to_numpy(dtype=np.int64).view(_U))


def _describe(batches: Iterator[pa.RecordBatch], law: Similarity, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per text: size and hash of its set, and its signatures unless the task has seen the set before."""
    seen: set[int] = set()
    for batch in batches:
        ids, text, texts_hash = batch.columns
        for first, end, data, starts in wa.slices(text):
            values, bounds, sizes = wa.sets_of(data, starts, law.words)
            node = fingerprint(values, bounds)
            if len(seen) > 1_000_000:
                seen.clear()
            new = np.zeros(end - first, dtype=bool)
            for i, x in enumerate(node.tolist()):
                if x and x not in seen:
                    seen.add(x)
                    new[i] = True
            sig, row = signatures(values, bounds, law, frequent)
            keep = new[row]
            sig, row = sig[keep], row[keep]
            order = np.argsort(row, kind="stable")
            count = np.bincount(row, minlength=end - first)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32)), pa.array(sig[order].view(np.int64))
            )
            part = ids.slice(first, end - first)
            parity = [p if fresh else None for p, fresh in zip(parity_bitmaps(values, sizes), new.tolist())]
            lone = pa.array([None if known else t for known, t in zip(part.is_valid().to_pylist(), text.slice(first, end - first).to_pylist() if part.null_count else [None] * (end - first))], pa.string())
            yield pa.RecordBatch.from_arrays(
                [part, texts_hash.slice(first, end - first), pa.array(sizes.astype(np.int64)), pa.array(node.view(np.int64)), lists, pa.array(parity, pa.binary()), lone],
                names=["doc_id", "text_hash", "n_shingles", "node", "sigs", "parity", "own_text"],
            )


class _Links:
    """Union-find over the nodes of one block."""

    def __init__(self, labels):
        self.to = {x: x for x in labels}

    def find(self, x):
        while self.to[x] != x:
            self.to[x] = self.to[self.to[x]]
            x = self.to[x]
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        self.to[max(a, b)] = min(a, b)
        return a != b


def _sets(texts, law: Similarity) -> list[np.ndarray]:
    out = []
    for _, _, data, starts in wa.slices(pa.array(texts, pa.string())):
        values, bounds, sizes = wa.sets_of(data, starts, law.words)
        out += [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def _verify(batches: Iterator[pa.RecordBatch], law: Similarity) -> Iterator[pa.RecordBatch]:
    """Keep pairs whose sets are linked."""
    kept: dict[int, np.ndarray] = {}
    for batch in batches:
        a, b, text_a, text_b = batch.columns
        good = []
        left, right = a.to_pylist(), b.to_pylist()
        for i in range(len(left)):
            pair = []
            for node, text in ((left[i], text_a), (right[i], text_b)):
                if node not in kept:
                    if len(kept) >= 256:
                        kept.clear()
                    kept[node] = _sets([text[i].as_py()], law)[0]
                pair.append(kept[node])
            x, y = pair
            small, big = (x, y) if len(x) <= len(y) else (y, x)
            if not len(small) or not law.linked(len(small), len(small), len(big)):
                continue
            at = np.minimum(np.searchsorted(big, small), len(big) - 1)
            good.append(i) if law.linked(int((big[at] == small).sum()), len(x), len(y)) else None
        yield pa.RecordBatch.from_arrays([a.take(pa.array(good, pa.int64())), b.take(pa.array(good, pa.int64()))], names=["a", "b"])


def _compare_blocks(left, right, law: Similarity):
    """Links between the components of two blocks: each left set against all right sets."""
    import pandas as pd

    if not len(left) or not len(right):
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    sets = _sets(left["text"].tolist(), law)
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(merged := np.concatenate(sets), kind="stable")
    merged, owner = merged[order], np.repeat(np.arange(len(sets)), sizes)[order]
    label_l, node_l = left["label"].tolist(), left["node"].tolist()
    links, found = _Links({*label_l, *right["label"].tolist()}), []
    for node, label, text in zip(right["node"].tolist(), right["label"].tolist(), right["text"].tolist()):
        own = _sets([text], law)[0]
        low, high = np.searchsorted(merged, own, "left"), np.searchsorted(merged, own, "right")
        n = high - low
        ends = np.cumsum(n)
        hits = np.arange(ends[-1]) - np.repeat(ends - n - low, n)
        shared = np.bincount(owner[hits], minlength=len(sets))
        for i in np.flatnonzero(law.linked(shared, sizes, len(own))):
            if links.join(label_l[i], label):
                found.append((node_l[i], node))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _differences(batches: Iterator[pa.RecordBatch], law: Similarity) -> Iterator[pa.RecordBatch]:
    """Sizes of sets and their symmetric differences from their component's leading set."""
    leads: dict[int, np.ndarray] = {}
    for batch in batches:
        cluster, node, copies, text, lead_text = batch.columns
        sizes, parts = [], []
        for i, own in enumerate(_sets(text, law)):
            key = cluster[i].as_py()
            if key not in leads:
                if len(leads) >= 256:
                    leads.clear()
                leads[key] = _sets([lead_text[i].as_py()], law)[0]
            sizes.append(len(own))
            parts.append(np.setxor1d(own, leads[key], assume_unique=True))
        ends = np.cumsum([0] + [len(x) for x in parts]).astype(np.int32)
        flat = np.concatenate(parts) if parts else np.zeros(0, _U)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [cluster, node, copies, pa.array(sizes, pa.int64()), lists], names=["cluster", "node", "copies", "size", "other"]
        )


def _count_between(left, right, same: bool, law: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Copies that each left set, and each right set, is linked with on the other side; ``same`` if the sides are one."""
    parts = [np.asarray(x, dtype=np.int64).view(_U) for x in left["other"]]
    lengths = np.array([len(x) for x in parts])
    merged = np.concatenate(parts)
    order = np.argsort(merged, kind="stable")
    merged, owner = merged[order], np.repeat(np.arange(len(parts)), lengths)[order]
    sizes, copies = left["size"].to_numpy(), left["copies"].to_numpy()
    of_left, of_right = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
    for r, (other, size, n) in enumerate(zip(right["other"], right["size"].tolist(), right["copies"].tolist())):
        own = np.asarray(other, dtype=np.int64).view(_U)
        low, high = np.searchsorted(merged, own, "left"), np.searchsorted(merged, own, "right")
        many = high - low
        ends = np.cumsum(many)
        hits = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many - low, many)
        # Sets differ where their differences from the leading set do.
        differ = lengths + len(own) - 2 * np.bincount(owner[hits], minlength=len(parts))
        linked = law.linked((sizes + size - differ) // 2, sizes, size)
        if same:
            linked[r] = False
        of_right[r] = copies[linked].sum()
        of_left[linked] += n
    return of_left, of_right


def _count_block(rows, law: Similarity):
    """``(node, links)`` of one group of the counting step, which may hold several small components."""
    import pandas as pd

    out = []
    for _, held in rows.groupby("cluster", sort=False):
        same = held["i"].iat[0] == held["j"].iat[0]
        left = held if same else held[held["place"] == held["i"]]
        right = held if same else held[held["place"] == held["j"]]
        if not len(left) or not len(right):
            continue
        of_left, of_right = _count_between(left, right, same, law)
        out.append(pd.DataFrame({"node": right["node"], "links": of_right}))
        if not same:
            out.append(pd.DataFrame({"node": left["node"], "links": of_left}))
    found = pd.concat(out) if out else pd.DataFrame({"node": np.zeros(0, np.int64), "links": np.zeros(0, np.int64)})
    return found[found["links"] > 0]


def _count_links(label: DataFrame, copies: DataFrame, texts: _Texts, law: Similarity) -> DataFrame:
    """``(node, links)``: copies of all other sets each set of ``label (node, component)`` is linked with."""
    label = materialise(label, "label")

    def differences(part: DataFrame, text: DataFrame) -> DataFrame:
        # A component is named after one of its sets.
        leads = text.select(F.col("node").alias("cluster"), F.col("text").alias("lead_text"))
        held = part.withColumnRenamed("component", "cluster").join(copies, "node").join(text, "node").join(leads, "cluster")
        return held.select("cluster", "node", "copies", "text", "lead_text").mapInArrow(
            lambda it: wa.returning(_differences(it, law)), "cluster long, node long, copies long, size long, other array<long>"
        )

    held = texts.used(label, "component", ["node", "component"], differences, "differences")
    weight = F.greatest(F.lit(1 / COUNTED), 8 * F.size("other") / COUNTED_BYTES)
    total = held.agg(F.sum(weight)).first()[0] or 0
    sizes = held.groupBy("cluster").agg(F.ceil(F.sum(weight)).cast("int").alias("blocks")).where("blocks > 1")
    held = held.join(materialise(sizes, "sizes"), "cluster", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    # Components of one block share groups; those of more have a group for each pair of blocks.
    shared = F.pmod(F.xxhash64("cluster"), F.lit(max(1, round(4 * total))))
    held = held.withColumn("pool", F.when(F.col("blocks") == 1, shared).otherwise(F.col("cluster")))
    held = held.withColumn("place", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    held = held.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = held.withColumn("i", F.least("place", "met")).withColumn("j", F.greatest("place", "met"))
    found = held.select("pool", "i", "j", "place", "cluster", "node", "copies", "size", "other").groupBy("pool", "i", "j").applyInPandas(
        lambda rows: _count_block(rows, law), "node long, links long"
    )
    return found.groupBy("node").agg(F.sum("links").alias("links"))


def _slices(rows: int, full: int) -> int:
    return min(MOST_SLICES, -(-rows // full) or 1)


def _sliced(df: DataFrame, key: str, n: int) -> list[DataFrame]:
    """``df`` in ``n`` parts by a hash of ``key``."""
    return [df.where(F.pmod(F.xxhash64(F.lit(n), key), F.lit(n)) == i) for i in range(n)] if n > 1 else [df]


def _written(parts: Iterable[DataFrame], name: str) -> list[DataFrame]:
    """Each part written, one after another; the shuffle files of one are gone before the next is made."""
    return [materialise(part, name) for part in parts]


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


class _Texts:
    """Texts of sets, fetched from the documents for one slice of pairs or components at a time."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, law: Similarity):
        self.docs, self.nodes, self.law = docs, nodes, law
        self.full = max(SLICE_PAIRS, nodes.count() // MOST_SLICES)

    def used(self, rows: DataFrame, key: str, columns: list[str], make: Callable, name: str) -> DataFrame:
        """``make(slice, texts)`` over all slices of ``rows`` by ``key``, written; ``texts (node, text)`` has the nodes in ``columns``."""
        done = []
        for part in _sliced(rows, key, _slices(rows.count(), self.full)):
            wanted = part.select(F.explode(F.array(*columns)).alias("node")).distinct()
            texts = materialise(_texts(self.docs, self.nodes, wanted, self.law), "texts")
            done += _written([make(part, texts)], name)
            discard(texts)
        return _together(done)


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, law: Similarity) -> DataFrame:
    """``(node, text)`` of the wanted nodes, each from one of its documents.

    Where a doc_id is repeated, only texts whose set the node stands for are taken. One step in Python does it all: with a
    second one behind the join a task would hold two worker processes.
    """
    held = nodes.join(wanted, "node", "left_semi")
    first = held.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("own_text").alias("own_text"))
    first = materialise(first, "wanted")
    marks = nodes.sparkSession.sparkContext.broadcast(bitmap_of(first, F.xxhash64("doc_id")))
    near = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h"))
    near = near.mapInArrow(lambda it: wa.returning(_marked(it, marks.value, law)), "doc_id long, node long, text string")
    by_id = near.join(first.where("doc_id is not null").select("doc_id", "node"), ["doc_id", "node"])
    # A node has one doc_id here, so its repeated rows are together already.
    by_id = by_id.dropDuplicates(["doc_id", "node"])
    return by_id.select("node", "text").union(first.where("doc_id is null").select("node", "own_text"))


def _marked(batches: Iterator[pa.RecordBatch], marks: np.ndarray, law: Similarity) -> Iterator[pa.RecordBatch]:
    """``(doc_id, node, text)`` of rows whose hash has its bit."""
    for batch in batches:
        keep = may_hold(marks, batch.column(2).to_numpy(zero_copy_only=False))
        ids, text = batch.select([0, 1]).filter(pa.array(keep)).columns
        node = [np.zeros(0, np.int64)]
        for _, _, data, starts in wa.slices(text):
            values, bounds, _ = wa.sets_of(data, starts, law.words)
            node.append(fingerprint(values, bounds).view(np.int64))
        yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(node)), text], names=["doc_id", "node", "text"])


def _met(batches: Iterator[pa.RecordBatch], marks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``(sig, node)`` of the signatures that have their bit."""
    for batch in batches:
        sigs = batch.column(1)
        flat = sigs.flatten().to_numpy(zero_copy_only=False)
        keep = may_hold(marks, flat)
        node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), pc.list_value_length(sigs).fill_null(0).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(flat[keep]), pa.array(node[keep])], names=["sig", "node"])


def similar_components(docs: DataFrame, law: Similarity = Similarity(), count_links: bool = False) -> DataFrame:
    """``(doc_id, n_shingles, component_id, text_hash, cluster)``, one row per row of ``docs (doc_id, text, ...)``.

    ``component_id`` is the smallest doc_id that links reach, itself included. Texts without a
    word (null, empty, only white space) have no shingles and are linked with nothing:
    their component is their own doc_id. Texts with equal sets are linked. Rows with a null
    doc_id keep their null; their component is the smallest known doc_id in reach, or null.
    Repeated rows are returned as often as given; an empty table gives no rows; other
    columns of any name are ignored. Sets equal under a 64-bit hash count as equal. ``cluster`` labels
    the component whatever its doc_ids are (null without a word), ``text_hash`` the text.

    ``count_links`` adds ``n_links``: how many other rows the row's text is linked with, rows with an equal
    set among them, directly and not through further texts; 0 without a word.
    """
    spark = docs.sparkSession
    wa.short_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, law))
    rows = materialise(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
            lambda it: wa.returning(_describe(it, law, frequent.value)),
            "doc_id long, text_hash long, n_shingles long, node long, sigs array<long>, parity binary, own_text string",
        ),
        "sets",
    )
    dealt = rows.where("node <> 0").select(F.explode("sigs").alias("sig"), "node")
    n = _slices(rows.agg(F.sum(F.size("sigs"))).first()[0] or 0, SLICE_ROWS)
    groups = [part.groupBy("sig").agg(F.min("node").alias("low"), F.max("node").alias("high")) for part in _sliced(dealt, "sig", n)]
    parts = _written((part.where("low < high").select("sig") for part in groups), "groups")
    groups = _together(parts)
    # Members of signature groups with more than one set: small next to all signatures.
    marks = spark.sparkContext.broadcast(bitmap_of(groups, F.col("sig")))
    met = rows.where("node <> 0").select("node", "sigs").mapInArrow(lambda it: wa.returning(_met(it, marks.value)), "sig long, node long")
    met = zip(_sliced(met, "sig", n), parts)
    held = _written((some.join(part, "sig", "left_semi").distinct() for some, part in met), "members")
    members = _together(held)
    discard(*parts)
    involved = members.select("node").distinct()
    known = rows.where("parity is not null").select("node", F.col("n_shingles").alias("size"), "parity")
    parities = materialise(known.join(involved, "node", "left_semi").dropDuplicates(["node"]), "parities")
    # From here on no signatures are asked for.
    whole = rows
    rows = materialise(whole.select("doc_id", "text_hash", "n_shingles", "node", "own_text"), "nodes")
    discard(whole)
    nodes = rows.where("node <> 0")
    texts = _Texts(docs, nodes.select("doc_id", "node", "own_text"), law)
    links = _links(members, texts, parities, law)
    discard(*held, parities)
    label = components(links) if links is not None else None
    ids = nodes.groupBy("node").agg(F.min("doc_id").alias("lowest"), F.count("*").alias("copies"))
    counted = None
    if count_links and label is not None:
        counted = materialise(_count_links(label, ids.select("node", "copies"), texts, law), "counted")
    ids = ids.withColumn("cluster", F.col("node")) if label is None else ids.join(
        label.withColumnRenamed("component", "cluster"), "node", "left"
    ).withColumn("cluster", F.coalesce("cluster", "node"))
    best = ids.groupBy("cluster").agg(F.min("lowest").alias("component_id"))
    ids = ids.join(best, "cluster").select("node", "cluster", "component_id", "copies")
    columns = ["doc_id", "n_shingles", "component_id", "text_hash", "cluster"]
    if count_links:
        others = F.lit(0) if counted is None else F.coalesce("links", F.lit(0))
        ids = (ids if counted is None else ids.join(counted, "node", "left")).withColumn("linked", others + F.col("copies") - 1)
        columns.append("n_links")
    component = F.when(F.col("node") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    found = rows.join(ids, "node", "left").withColumn("component_id", component)
    if count_links:
        found = found.withColumn("n_links", F.coalesce("linked", F.lit(0)).cast("long"))
    return found.select(*columns)


def keep_one(docs: DataFrame, law: Similarity = Similarity()) -> DataFrame:
    """``docs`` with one row of each group of similar texts, all columns as they are.

    The row with the smallest doc_id stays (nulls last; then the smallest text hash; of rows equal in both any one).
    Texts without a word are no group: all their rows stay.
    """
    found = similar_components(docs, law).where("cluster is not null").select("doc_id", "text_hash", "cluster")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    stays = found.groupBy("cluster").agg(F.min(first).alias("first"))
    # Plain keys, so that the rows of one are still together after the join and texts are shuffled once.
    key = lambda doc_id, text_hash: [F.coalesce(doc_id, F.lit(0)).alias("_own_id"), doc_id.isNull().alias("_own_null"), text_hash.alias("_own_hash")]
    keys = ["_own_id", "_own_null", "_own_hash"]
    stays = materialise(stays.select(*key(F.col("first.doc_id"), F.col("first.text_hash"))), "stays")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    held = docs.select(*columns, *key(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))))
    worded = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    one = held.where(worded).join(stays, keys).dropDuplicates(keys)
    return one.select(*columns).union(held.where(~worded).select(*columns))


def _links(members: DataFrame, texts: _Texts, parities: DataFrame, law: Similarity) -> DataFrame | None:
    """Verified links that connect whatever the signature groups' members connect."""
    links, left, parts = None, members.withColumn("label", F.col("node")), []
    many = left.count()
    if not many:
        return None
    for turn in range(ROUNDS):
        # The leader of a group is another member each turn; only other components are compared with it.
        pick = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "label")
        a, b = F.least("node", F.col("lead.node")), F.greatest("node", F.col("lead.node"))
        n = _slices(many, SLICE_ROWS)
        led = (
            some.join(some.groupBy("sig").agg(F.min(pick).alias("lead")), "sig").where("label <> lead.label")
            .select(a.alias("a"), b.alias("b")).distinct()
            for some in _sliced(left, "sig", n)
        )
        pairs = _written(led, "pairs") if n > 1 else [*led]
        found = _checked(_together(pairs).distinct() if n > 1 else pairs[0], texts, parities, law)
        discard(*(pairs if n > 1 else []))
        links = found if links is None else links.union(found)
        label = components(links)
        before, parts = parts, _written((_still_open(some, label) for some in _sliced(left, "sig", n)), "open")
        left = _together(parts)
        discard(*before)
        many = left.count()
        if not many:
            return links
        if found.isEmpty():
            break
    # Small groups: their pairs, at most PAIRWISE / 2 for each member.
    counts = left.groupBy("sig").agg(F.count("*").alias("n"))
    few = left.join(counts.where(F.col("n") <= PAIRWISE).select("sig"), "sig", "left_semi")
    pairs = _pairs_within(few, "sig")
    many = materialise(left.join(counts.where(F.col("n") > PAIRWISE).select("sig"), "sig", "left_semi"), "open")
    large = None
    if not many.isEmpty():
        near = materialise(_near_clusters(many, parities, law), "near")
        counts = near.groupBy("cluster").agg(F.count("*").alias("n"))
        small = near.join(counts.where(F.col("n") <= PAIRWISE).select("cluster"), "cluster", "left_semi")
        pairs = pairs.union(_pairs_within(small, "cluster"))
        large = near.join(counts.where(F.col("n") > PAIRWISE).select("cluster"), "cluster", "left_semi")
        large = materialise(large.select("cluster", "node", "label"), "clusters")
    links = links.union(_checked(pairs.distinct(), texts, parities, law))
    discard(*parts, many)
    if large is None or large.isEmpty():
        return links
    return links.union(texts.used(large, "cluster", ["node"], lambda part, text: _block_links(part, text, law), "links"))


def _still_open(members: DataFrame, label: DataFrame) -> DataFrame:
    """``(sig, node, label)`` of groups that hold several components."""
    known = members.select("sig", "node").join(label, "node", "left")
    known = known.select("sig", "node", F.coalesce("component", "node").alias("label"))
    spread = known.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return known.join(spread.where("low < high").select("sig"), "sig", "left_semi")


def _pairs_within(rows: DataFrame, key: str) -> DataFrame:
    """``(a, b)``: the pairs of different labels of each group."""
    other = rows.select(key, F.col("node").alias("b"), F.col("label").alias("label_b"))
    return rows.withColumnRenamed("node", "a").join(other, key).where("a < b and label <> label_b").select("a", "b")


def _checked(pairs: DataFrame, texts: _Texts, parities: DataFrame, law: Similarity) -> DataFrame:
    """The linked ones of ``pairs``, written; bitmaps are brought together first, texts only for the pairs these leave."""

    def beside(rows: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        for side in "ab":
            rows = rows.join(table.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
        return rows.select("a", "b", *[f"{c}_{side}" for c in columns for side in "ab"])

    sifted = materialise(beside(pairs, parities, "size", "parity").mapInArrow(lambda it: wa.returning(_sift(it, law)), "a long, b long"), "sifted")
    verify = lambda part, text: beside(part, text, "text").mapInArrow(lambda it: wa.returning(_verify(it, law)), "a long, b long")
    found = texts.used(sifted, "a", ["a", "b"], verify, "links")
    discard(sifted)
    return found


def _near_clusters(left: DataFrame, parities: DataFrame, law: Similarity) -> DataFrame:
    """``(cluster, node, label)`` of the sets that their sizes and bitmaps leave a link with another component.

    Groups that share members meet in blocks; any two sets that may be linked are in one of the clusters returned.
    """
    low = left.groupBy("sig").agg(F.min("node").alias("low"))
    cluster = components(left.join(low, "sig").select(F.col("node").alias("a"), F.col("low").alias("b")))
    held = left.select("node", "label").distinct().join(cluster.withColumnRenamed("component", "cluster"), "node").join(parities, "node")
    held = materialise(held.select("cluster", "node", "label", "size", "parity"), "clusters")
    weight = F.greatest(F.lit(1 / SIFTED), F.octet_length("parity") / SIFTED_BYTES)
    met = _in_blocks(held, weight).applyInPandas(
        lambda rows: _sift_block(rows[rows["side"] == 0], rows[rows["side"] == 1], law), "a long, b long"
    )
    met = materialise(met, "near")
    return held.select("node", "label").join(components(met).withColumnRenamed("component", "cluster"), "node").select("cluster", "node", "label")


def _block_links(held: DataFrame, texts: DataFrame, law: Similarity) -> DataFrame:
    """Compare all components of each cluster of ``held (cluster, node, label)``, block by block."""
    weight = F.greatest(F.lit(1 / BLOCK), F.octet_length("text") / BLOCK_BYTES)
    return _in_blocks(held.join(texts, "node"), weight).applyInPandas(
        lambda rows: _compare_blocks(rows[rows["side"] == 0], rows[rows["side"] == 1], law), "a long, b long"
    )


def _in_blocks(held: DataFrame, weight: Column):
    """Groups in which any two rows of different components of a cluster meet once, on side 0 and side 1.

    A cluster's largest component is compared with the others only, so a cluster costs (members outside that
    component) x (members). Rows of weight 1 fill a block.
    """
    sizes = held.groupBy("cluster", "label").agg(F.sum(weight).alias("n"))
    sizes = sizes.groupBy("cluster").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
    sizes = materialise(
        sizes.select(
            "cluster", F.col("top.label").alias("top"),
            F.ceil("all").cast("int").alias("blocks"),
            F.greatest(F.ceil(F.col("all") - F.col("top.n")), F.lit(1)).cast("int").alias("few"),
        ),
        "sizes",
    )
    fields = ["side", "cluster", "i", "j", *[c for c in held.columns if c != "cluster"]]
    held = held.join(sizes, "cluster")
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    outside = held.where("label <> top").withColumn("side", F.lit(0)).withColumn("i", place("few"))
    outside = outside.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = held.withColumn("side", F.lit(1)).withColumn("j", place("blocks"))
    every = every.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("few") - 1)))
    return outside.select(fields).union(every.select(fields)).groupBy("cluster", "i", "j")
