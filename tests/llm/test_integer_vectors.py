"""Grid codes and hard negatives against brute force in plain Python integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from loomvec.llm import grid_codes as gc
from loomvec.llm import hard_negatives as hn
from loomvec.llm import queries

SCHEMA = "vec_id long, embedding array<double>, label int, row string, v string, error string, score string, block int, side int"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "v", "e", "s", 1, 2) for r in rows], SCHEMA).repartition(3)


def whole(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def some_rows(n=300, size=16, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    values = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, size)) * 0.4
    values /= np.linalg.norm(values, axis=1, keepdims=True)
    values[20:120] = values[20]  # one very common vector
    return [(i, values[i].tolist(), None if i % 11 == 3 else i % 4) for i in range(n)]


def awkward(size=16):
    v = [0.25 * (-1) ** i for i in range(size)]
    return [
        (1000, None, 1), (1001, [NAN] * size, 1), (1002, [INF] + v[1:], 1), (1003, [None] + v[1:], 1), (1004, [0.0] * size, 1),
        (1100, v, 2), (1100, v, 2), (1100, [-x for x in v], 2), (1200, v, 3), (-100, v, 2), (-7, v, 1), (None, v, 2), (None, v, None),
    ]


# --- codes


def brute_codes(rows, s):
    """``(vec_id, code, error, label_error, digest)`` by comparing every part with every entry."""
    held = [(i, [math.floor(s.scale * x) for x in v], label) for i, v, label in whole(rows)]
    out = []
    for size in {len(v) for _, v, _ in held}:
        mine = [r for r in held if len(r[1]) == size]
        first = sorted(mine, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[: s.entries]
        coded = [[0] * s.parts for _ in mine]
        far = [0] * len(mine)
        digest = []
        for p in range(s.parts):
            a, b = size * p // s.parts, size * (p + 1) // s.parts
            book = [r[1][a:b] for r in first]

            def nearest(x):
                return min((sum((q - c) ** 2 for q, c in zip(x, e)), k) for k, e in enumerate(book))

            for _ in range(s.rounds):
                groups = {}
                for r in mine:
                    groups.setdefault(nearest(r[1][a:b])[1], []).append(r[1][a:b])
                for k, group in groups.items():
                    book[k] = [sum(x) // len(group) for x in zip(*group)]
            for n, r in enumerate(mine):
                d, coded[n][p] = nearest(r[1][a:b])
                far[n] += d
            digest += [str(x) for e in book for x in e]
        digest = hashlib.sha256(",".join(digest).encode()).hexdigest()
        out += [(r[0], "".join(f"{c:02x}" for c in coded[n]), far[n], r[2], digest) for n, r in enumerate(mine)]
    total = {}
    for r in out:
        total[r[3]] = total.get(r[3], 0) + r[2]
    return sorted(((i, c, e, total[label], d) for i, c, e, label, d in out), key=str)


def codes(spark, rows, s):
    found = gc.encode(frame(spark, rows), s)
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found.collect()), key=str)


@pytest.mark.parametrize("cell", [1, 64, 512, 100_000])
def test_codes_equal_brute_force_whatever_the_grid(spark, cell):
    s = gc.Settings(cell=cell, most_cells=40)
    rows = some_rows()
    assert codes(spark, rows, s) == brute_codes(rows, s)


def test_codes_of_awkward_vectors(spark):
    # Other lengths (one not divided by the number of parts, one shorter than it), an empty vector, few rows.
    rows = some_rows(40) + awkward() + [(2000, [0.5] * 13, 1), (2001, [0.25] * 13, 1), (2002, [1.0, 2.0], None), (2003, [], 5), (2004, [], None)]
    s = gc.Settings()
    assert codes(spark, rows, s) == brute_codes(rows, s)
    assert codes(spark, rows[:3], s) == brute_codes(rows[:3], s)


def test_codes_of_nothing(spark):
    assert codes(spark, [], gc.Settings()) == []
    assert codes(spark, [(1, None, 1), (2, [NAN], 1)], gc.Settings()) == []


def test_too_large_a_component_is_an_error(spark):
    with pytest.raises(Exception, match="leaves"):
        gc.encode(frame(spark, [(1, [1e9], 1)])).collect()


def test_memo_saves_comparisons_and_survives_equal_hashes():
    rng = np.random.default_rng(1)
    book = rng.integers(-400, 400, (16, 2))
    parts = rng.integers(-500, 500, (4000, 2))
    far = ((parts[:, None, :] - book) ** 2).sum(axis=2)
    memo = gc.Memo(book, 64, 1000)
    entry, best = memo.nearest(parts)
    assert (entry == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
    assert memo.evaluated < 0.5 * 16 * len(parts)
    memo = gc.Memo(book, 64, 1000)
    memo.odd = np.zeros(2, np.uint64)  # every cell now has the same hash
    assert (memo.nearest(parts)[0] == far.argmin(axis=1)).all()


# --- hard negatives


def brute_negatives(rows, s):
    held = [(i, [math.floor(s.scale * x) for x in v], label) for i, v, label in whole(rows) if i is not None and label is not None]
    out = []
    for n, (i, v, label) in enumerate(held):
        if i % s.every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j, other) for m, (j, w, other) in enumerate(held) if m != n and len(w) == len(v)]
        for top, j, _ in sorted(x for x in scores if x[2] == label)[: s.positives]:
            inside = sorted(x for x in scores if x[2] != label and s.low * -top <= 100 * -x[0] <= s.high * -top)
            out += [(i, j, rank + 1, k, -top, -score) for rank, (score, k, _) in enumerate(inside[: s.negatives])]
    return sorted(out)


def negatives(spark, rows, s):
    return sorted(tuple(r) for r in hn.mine(frame(spark, rows), s).collect())


@pytest.mark.parametrize("settings", [
    hn.Settings(every=10), hn.Settings(every=10, block=30, cells=64, least_blocks=2), hn.Settings(every=7, scale=5, positives=9, negatives=2),
    hn.Settings(every=10, scale=40_000),
])
def test_negatives_equal_brute_force(spark, settings):
    rows = some_rows(260)
    want = brute_negatives(rows, settings)
    assert len(want) > 50
    assert negatives(spark, rows, settings) == want


def test_negatives_of_awkward_rows(spark):
    rows = some_rows(120) + awkward() + [(300, [0.5] * 3, 1), (301, [0.5] * 3, 1), (302, [0.5] * 3, 2), (400, [], 1), (401, [], 1), (402, [], 2)]
    s = hn.Settings(least_blocks=3)
    assert negatives(spark, rows, s) == brute_negatives(rows, s)


def test_negatives_of_nothing(spark):
    assert negatives(spark, [], hn.Settings()) == []
    assert negatives(spark, [(100, [1.0], 1), (101, [1.0], 1)], hn.Settings()) == []
    assert negatives(spark, [(100, [0.0], 1), (101, [0.0], 1), (102, [0.0], 2)], hn.Settings()) == [(100, 101, 1, 102, 0, 0)]


@pytest.mark.parametrize("size", [1, 63, 64, 65, 300])
@pytest.mark.parametrize("most", [3, 1000, 1 << 24])
def test_residue_products_are_exact(size, most):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-most, most, (20, size)), rng.integers(-most, most, (30, size))
    a[0], b[0], b[1] = most, most, -most
    bound = max(int((a.astype(object) ** 2).sum(axis=1).max()), int((b.astype(object) ** 2).sum(axis=1).max()))
    primes = hn.primes_for(bound)
    got = hn.Residues(a, primes).products(hn.Residues(b, primes))
    assert (got == a.astype(object) @ b.astype(object).T).all()


def test_scores_beyond_62_bits_are_an_error():
    with pytest.raises(ValueError):
        hn.primes_for(1 << 62)


@pytest.mark.parametrize("name", ["op11_grid_codes", "op13_residue_negatives"])
def test_queries_agree_with_sql(spark, name):
    from tests.oracle import differences

    rows, only_spark, only_sql = differences(spark, "/root/testdata/sf0.01", queries.QUERIES[name], queries.ORACLES[name])
    assert rows > 0 and not only_spark and not only_sql
