from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from loomvec.llm import jaccard_join as jj
from loomvec.llm import wordarrays as wa
from loomvec.llm.components import components
from tests.llm import texts

LAW = jj.Similarity(words=4, percent=85)


def found(docs, law=LAW):
    rows = jj.similar_components(docs, law).collect()
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def test_awkward_rows_equal_brute_force(spark):
    docs = [(r[0], r[1]) for r in texts.rows()]
    assert found(texts.frame(spark)) == Counter(texts.components(docs, 4, 85))


def test_empty_table(spark):
    assert not found(texts.empty(spark))
    assert jj.keep_one(texts.empty(spark)).count() == 0


def edited(rng, base, changes):
    out = list(base)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def test_near_copies_around_the_limit_equal_brute_force(spark):
    """A large group in which some pairs are links and many are just not, beside a passage many texts share."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(90)]
    passage = [f"shared{i}" for i in range(55)]
    docs = [" ".join(edited(rng, base, rng.randrange(1, 9))) for _ in range(260)]
    docs += [" ".join([f"own{n}x{i}" for i in range(rng.randrange(5, 90))] + passage) for n in range(120)]
    docs += [" ".join(f"w{rng.randrange(6)}" for _ in range(rng.randrange(1, 12))) for _ in range(120)]
    docs = list(enumerate(docs))
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert found(frame) == Counter(texts.components(docs, 4, 85))


def test_no_task_holds_two_worker_processes(spark, monkeypatch):
    """Each written step has Python once, and a repeated doc_id still gives every node a text of its own set."""
    steps = []

    def noted(df, name):
        steps.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")))
        return written(df, name)

    written = jj.materialise
    monkeypatch.setattr(jj, "materialise", noted)
    rng = random.Random(3)
    bases = [[f"b{n}x{i}" for i in range(60)] for n in range(3)]
    docs = [(n % 7, " ".join(edited(rng, bases[n % 3], 3))) for n in range(60)] + [(None, " ".join(b)) for b in bases]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    jj.similar_components(frame, LAW).collect()
    assert dict(steps)["texts"] == 1 and max(n for _, n in steps) == 1
    assert found(frame) == Counter(texts.components(docs, 4, 85))


def test_texts_are_fetched_only_for_sets_that_may_be_linked(spark, monkeypatch):
    """Texts that share a passage and no more meet in large groups; their texts are not brought together."""
    rows = {}

    def noted(df, name):
        table = written(df, name)
        rows.setdefault(name, []).append(table.count())
        return table

    written = jj.materialise
    monkeypatch.setattr(jj, "materialise", noted)
    rng = random.Random(11)
    passages = [[f"p{n}x{i}" for i in range(30)] for n in range(8)]
    docs = [" ".join([f"own{n}x{i}" for i in range(rng.randrange(35, 60))] + passages[n % 8]) for n in range(300)]
    near = [f"near{i}" for i in range(90)]
    docs += [" ".join(edited(rng, near, 1)) for _ in range(6)]
    docs = list(enumerate(docs))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert found(frame) == Counter(texts.components(docs, 4, 85))
    assert max(rows["members"]) > 300
    assert sum(rows["texts"]) <= 20


def test_slices_give_what_one_step_gives(spark, monkeypatch):
    """Texts that all have near copies: signatures, members, pairs and texts go through the disk part by part."""
    rows = {}

    def noted(df, name):
        table = written(df, name)
        rows.setdefault(name, []).append(table.count())
        return table

    written = jj.materialise
    monkeypatch.setattr(jj, "materialise", noted)
    monkeypatch.setattr(jj, "SLICE_ROWS", 200)
    monkeypatch.setattr(jj, "SLICE_PAIRS", 10)
    monkeypatch.setattr(jj, "MOST_SLICES", 3)
    rng = random.Random(12)
    docs = []
    for g in range(30):
        start = [f"g{g}x{i}" for i in range(120)]
        docs += [" ".join(edited(rng, start, rng.randrange(2))) for _ in range(4)]
    docs = [*enumerate(docs), *((None, t) for t in docs[:3])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    made = jj.similar_components(frame, LAW, count_links=True).collect()
    assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in made) == link_counts(docs, 4, 85)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in made) == Counter(texts.components(docs, 4, 85))
    for name in ("groups", "members"):
        assert len(rows[name]) == 3 and max(rows[name]) < 0.6 * sum(rows[name])
    assert len(rows["differences"]) > 1 and sum(rows["differences"]) == rows["label"][0]


@pytest.mark.parametrize("percent", [50, 85])
def test_blocks_of_bitmaps_join_whatever_pairs_may_join(percent):
    import pandas as pd

    law, rng = jj.Similarity(4, percent), np.random.default_rng(percent)
    bases = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (3, 30, 34, 100, 900)]
    sets = [np.unique(np.concatenate((b[int(rng.integers(0, len(b) // 3 + 1)) :], rng.integers(0, 2**63, 2, dtype=np.uint64)))) for b in bases for _ in range(12)]
    parity = jj.parity_bitmaps(np.concatenate(sets), np.array([len(x) for x in sets]))
    rows = pd.DataFrame({"node": np.arange(len(sets)), "label": np.arange(len(sets)) // 2, "size": [len(x) for x in sets], "parity": parity})
    left, right = rows[rows["node"] % 3 > 0], rows
    may = lambda a, b: (
        law.linked(min(a.size, b.size), a.size, b.size) and jj.bits_apart(a.parity, b.parity) <= law.most_different(a.size + b.size)
    )
    records = list(rows.itertuples(index=False))
    wanted, got = jj._Links(range(len(sets))), jj._Links(range(len(sets)))
    allowed = {(a.node, b.node) for a in records for b in records if a.node % 3 and a.label != b.label and may(a, b)}
    for a, b in allowed:
        wanted.join(a, b)
    found = jj._sift_block(left, right, law)
    pairs = list(zip(found["a"].tolist(), found["b"].tolist()))
    assert pairs and len(pairs) < len(sets) and set(pairs) <= allowed
    for a, b in pairs:
        got.join(a, b)
    assert [wanted.find(i) for i in range(len(sets))] == [got.find(i) for i in range(len(sets))]
    assert not len(jj._sift_block(left[:0], right, law)) and not len(jj._sift_block(left, right[:0], law))


def test_memory_of_a_task_is_bounded_and_given_back(monkeypatch):
    texts_of = wa.pa.array(["some words of a text " * 100] * 2000)
    returned = []
    monkeypatch.setattr(wa, "give_back", lambda: returned.append(True))
    tracemalloc.start()
    for part in wa.returning(wa.slices(texts_of)):
        assert not returned
        wa.sets_of(part[2], part[3], 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert returned == [True] and peak < 40 << 20


def test_one_document_of_each_group_stays(spark):
    law = jj.Similarity(words=5, percent=80)
    kept = jj.keep_one(texts.frame(spark), law)
    assert kept.columns == texts.frame(spark).columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    groups = texts.components([(r[0], r[1]) for r in texts.rows()], 5, 80)
    worded = [g for g in groups if g[1]]
    # Components whose doc_ids are all null are told apart by their text.
    wanted = {c for _, _, c in worded if c is not None}
    assert sorted(i for i, t in rows if i is not None and texts.words(t)) == sorted(wanted)
    assert sum(1 for i, t in rows if i is None and t == "no id here at all") == 1
    assert sum(1 for i, t in rows if not texts.words(t)) == sum(1 for g in groups if not g[1])


@pytest.mark.parametrize("percent", [70, 80, 85, 95])
@pytest.mark.parametrize("size", [1, 3, 5, 6, 9, 14, 30, 200, 3000])
def test_similar_sets_share_a_signature(percent, size):
    """Sets with as many differences as still make a link, half of them on either side."""
    rng = np.random.default_rng(size)
    law = jj.Similarity(4, percent)
    for trial in range(30):
        shared = rng.integers(0, 2**63, size).astype(np.uint64)
        extra = 0
        while law.linked(size, size + (extra + 2) // 2, size + (extra + 1) // 2):
            extra += 1
        left = np.unique(np.concatenate((shared, rng.integers(0, 2**63, (extra + 1) // 2).astype(np.uint64))))
        right = np.unique(np.concatenate((shared, rng.integers(0, 2**63, extra // 2).astype(np.uint64))))
        frequent = np.sort(shared[: size // 3]) if trial % 2 else np.zeros(0, np.uint64)
        values, bounds = np.concatenate((left, right)), np.array([0, len(left), len(left) + len(right)])
        sig, row = jj.signatures(values, bounds, law, frequent)
        assert set(sig[row == 0]) & set(sig[row == 1])


def test_signatures_do_not_depend_on_the_slice():
    rng = np.random.default_rng(1)
    parts = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (3, 700, 12, 90)]
    whole = jj.signatures(np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts]))), LAW, np.zeros(0, np.uint64))
    for i, part in enumerate(parts):
        alone = jj.signatures(part, np.array([0, len(part)]), LAW, np.zeros(0, np.uint64))
        assert sorted(alone[0]) == sorted(whole[0][whole[1] == i])


def test_word_arrays_equal_a_plain_split():
    for _, text in [(r[0], r[1]) for r in texts.rows()]:
        raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
        for k in (1, 4, 5):
            assert wa.sets_of(raw, np.array([0, len(raw)]), k)[2][0] == len(texts.shingles(text, k))


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1400)]
    edges = spark.createDataFrame([*chain, *star, (5, 5), (3, 1000)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert all(got[i] == 100 for i in range(100, 161))
    assert all(got[i] == 3 for i in [3, 7, *range(1000, 1400)]) and 5 not in got
    assert components(edges.where("a < 0")).count() == 0


def test_components_by_rounds_and_on_the_driver_are_the_same(spark, monkeypatch):
    from loomvec.llm import components as module

    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(1000, 1060)] + [(5, 5), (3, 1000), (None, 4)]
    edges += [(rng.randrange(-500, 0), rng.randrange(-500, 0)) for _ in range(150)]
    frame = spark.createDataFrame(edges, "a long, b long")
    few = sorted((r.node, r.component) for r in components(frame).collect())
    monkeypatch.setattr(module, "FEW", 0)
    assert few == sorted((r.node, r.component) for r in components(frame).collect()) and len(few) > 100


def link_counts(docs, k, percent):
    """``(doc_id, text, other rows linked)`` by comparing all pairs of sets."""
    sets = [texts.shingles(t, k) for _, t in docs]
    linked = lambda a, b: bool(a and b) and 100 * len(a & b) >= percent * len(a | b)
    return Counter((i, len(a), sum(linked(a, b) for m, b in enumerate(sets) if m != n)) for n, ((i, _), a) in enumerate(zip(docs, sets)))


@pytest.mark.parametrize("block", [40, jj.COUNTED])
def test_links_are_counted_as_by_brute_force(spark, monkeypatch, block):
    """Groups of many different near copies, some pairs linked and some not, with exact copies, in one block and in several."""
    monkeypatch.setattr(jj, "COUNTED", block)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(90)]
    docs = [" ".join(edited(rng, base, rng.randrange(1, 7))) for _ in range(150)]
    docs += rng.choices(docs, k=60)
    for g in range(20):
        start = [f"g{g}x{i}" for i in range(50)]
        docs += [" ".join(edited(rng, start, rng.randrange(3))) for _ in range(rng.randrange(1, 6))]
    docs = [*((i, t) for i, t in enumerate(docs, 1000)), *((r[0], r[1]) for r in texts.rows())]
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = jj.similar_components(frame, LAW, count_links=True).collect()
    assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in rows) == link_counts(docs, 4, 85)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == Counter(texts.components(docs, 4, 85))


def test_links_without_any_similar_text(spark):
    docs = spark.createDataFrame([(1, "one text"), (2, "another"), (3, "one text"), (4, None)], "doc_id long, text string")
    assert {r.doc_id: r.n_links for r in jj.similar_components(docs, LAW, count_links=True).collect()} == {1: 1, 2: 0, 3: 1, 4: 0}
    assert jj.similar_components(texts.empty(spark), LAW, count_links=True).count() == 0


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("size", [512, 1024, 2048, 4096])
def test_words_that_collide_modulo_powers_of_two(spark, size):
    word = thue_morse(size)
    other = word.translate(str.maketrans("ab", "ba"))
    texts_of = [word, other, f"one {word} two three four five", f"one {other} two three four five", word]
    frame = spark.createDataFrame(list(enumerate(texts_of, 1)), "doc_id long, text string")
    found = {r.doc_id: (r.component_id, r.n_links) for r in jj.similar_components(frame, jj.Similarity(words=4, percent=85), count_links=True).collect()}
    assert found == {1: (1, 1), 2: (2, 0), 3: (3, 0), 4: (4, 0), 5: (1, 1)}
    assert sorted(r.doc_id for r in jj.keep_one(frame, jj.Similarity(words=5, percent=80)).collect()) == [1, 2, 3, 4]


def test_parity_bitmaps_never_differ_by_more_than_the_sets():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        cut = int(rng.integers(0, len(a) + 1))
        b = np.unique(np.concatenate((a[cut:], rng.integers(0, 2**63, int(rng.integers(1, 900)), dtype=np.uint64))))
        x, y = jj.parity_bitmaps(np.concatenate((a, b)), np.array([len(a), len(b)]))
        assert jj.bits_apart(x, y) == jj.bits_apart(y, x) <= len(np.setxor1d(a, b))
        assert jj.bits_apart(x, x) == 0
    far = jj.parity_bitmaps(rng.integers(0, 2**63, 400, dtype=np.uint64), np.array([200, 200]))
    assert jj.bits_apart(*far) > LAW.most_different(np.array([400]))[0]
    assert jj.parity_bitmaps(np.zeros(0, np.uint64), np.zeros(0, np.int64)) == []
