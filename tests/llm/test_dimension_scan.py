from __future__ import annotations

import numpy as np
import pytest

from loomvec.llm import dimension_scan as ds

SCHEMA = "vec_id long, embedding array<float>, score string, list int"


def score(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(x) * float(y)
    return total


def brute(rows, k, every, kind=np.float32):
    best, good = {}, {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = tuple(float(kind(x)) for x in v)
        if (i, len(v)) not in good or v < good[i, len(v)]:
            good[i, len(v)] = v
    for (q, size), asked in good.items():
        if q % every == 0:
            order = sorted((-score(v, asked), i) for (i, n), v in good.items() if i != q and n == size)
            best[q] = [(i, -s) for s, i in order[:k]]
    return {q: found for q, found in best.items() if found}


def result(frame, settings):
    out = {}
    for r in sorted(ds.search(frame, settings).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("lengths", ["unit", "various"])
def test_recall_against_brute_force(spark, lengths):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 24))
    v = centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 24)) * 0.6
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    if lengths == "various":
        v *= rng.uniform(0.2, 3, (3000, 1))
    v[:400] = v[0]  # one very common vector
    rows = [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA).repartition(4)
    settings = ds.Settings(k=10, every=20, block=300, chunk=20, sample=1500)
    found, want = result(frame, settings), brute(rows, 10, 20)
    assert set(found) == set(want)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    exact = dict(rows)
    for q, rows_of in found.items():
        assert rows_of == sorted(rows_of, key=lambda r: (-r[1], r[0]))
        for i, got in rows_of:
            assert got == score(exact[i], exact[q])


@pytest.mark.parametrize("equal", [21, 34, 60, 139, 200])
@pytest.mark.parametrize("size", [7, 64])
def test_equal_vectors_tie_by_vec_id(spark, equal, size):
    rng = np.random.default_rng(equal)
    v = rng.normal(size=(equal + 40, size))
    v[:equal] = v[0]
    rows = [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA).repartition(3)
    found = result(frame, ds.Settings(block=50))
    assert found[0] == brute(rows, 20, 20)[0]
    ties = [i for i, _ in found[0] if i < equal]
    assert len(ties) >= 15 and ties == list(range(1, len(ties) + 1))


def test_components_that_only_doubles_hold(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.1, 0.2]), (2, [1e39, 0.0]), (3, [1e-50, 1e-60]), (4, [1e200, -1e200]), (20, [3e-320, 0.0])]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA.replace("array<float>", "array<double>"))
    found = result(frame, ds.Settings())
    assert found == brute(rows, 20, 20, float)
    assert found[0][2] == (1, 0.1)


def test_recall_on_the_given_vectors(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in given.select("vec_id", "embedding").collect()]
    v = np.array([r[1] for r in rows], dtype=np.float64)
    ids = np.array([r[0] for r in rows])
    found = result(given, ds.Settings())
    hits = 0
    for q in ids[ids % 20 == 0].tolist():
        s = v @ v[ids == q][0]
        s[ids == q] = -np.inf
        hits += len({i for i, _ in found[q]} & set(ids[np.argsort(-s, kind="stable")[:20]].tolist()))
    assert hits / (20 * (ids % 20 == 0).sum()) >= 0.95


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, None]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, []), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (20, [-1.0, 0.5]),
        (40, [2.0, 2.0]), (60, [3.0, 2.0, 1.0]), (80, [1.0] * 5),
    ]
    frame = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    found, want = result(frame, ds.Settings()), brute(rows, 20, 20)
    assert found == want
    assert ds.search(frame.where("vec_id < 0")).count() == 0
    one = result(frame.where("vec_id = 0"), ds.Settings())
    assert one == {}


def test_every_query_has_all_its_rows(spark):
    """Far apart clusters, of fewer vectors than a query asks for and single ones among them."""
    rng = np.random.default_rng(7)
    sizes = [300] * 6 + [6] * 20 + [1] * 20
    centres = rng.normal(size=(len(sizes), 24))
    centres *= 10 / np.linalg.norm(centres, axis=1, keepdims=True)
    v = np.concatenate([c + rng.normal(size=(n, 24)) * 0.01 for c, n in zip(centres, sizes)])
    rows = [(i, [float(x) for x in row], None, None) for i, row in enumerate(v)]
    found = result(spark.createDataFrame(rows, SCHEMA).repartition(4), ds.Settings(every=1))
    assert set(found) == set(range(len(v)))
    assert {len(of) for of in found.values()} == {20}
    small = spark.createDataFrame(rows[:15], SCHEMA)
    assert {len(of) for of in result(small, ds.Settings(every=1)).values()} == {14}


def test_lists_are_probed_until_they_hold_enough():
    centres = np.eye(4, dtype=np.float32)
    model = ds.Model(centres, np.eye(4), 1.0, 1)
    asks = np.array([[0.9, 0.5, 0.3, 0.1]], dtype=np.float32)
    sizes = np.array([2, 0, 3, 90])
    lists = {least: model.probed(asks, sizes, least)[0].tolist() for least in (1, 2, 3, 5, 6, 95, 200)}
    assert lists == {1: [0], 2: [0], 3: [0, 1, 2], 5: [0, 1, 2], 6: [0, 1, 2, 3], 95: [0, 1, 2, 3], 200: [0, 1, 2, 3]}
