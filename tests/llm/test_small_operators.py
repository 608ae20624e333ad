from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from loomvec.llm import bpe_matrix, fingerprints, hash_tree, language_id, mixing, token_rollup, toxicity, url_rules
from loomvec.session import scratch_path
from tests.llm import texts

# ---- shards


def assigned(docs, tree, after=None):
    return hash_tree.assign_shards(docs, tree, after).collect()


def test_shards_of_awkward_rows(spark):
    tree = hash_tree.grid(7, per_rack=2, racks=2)
    rows = assigned(texts.frame(spark), tree, hash_tree.grown(tree))
    given = texts.rows()
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in given)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert len({r.shard for r in rows if r.doc_id == 16}) == 1
    assert assigned(texts.empty(spark), tree) == []


def test_weights_and_movement(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    weights = {0: 3.0, 5: 0.5}
    tree = hash_tree.grid(12, per_rack=2, racks=2, weights=weights)
    before = {r.doc_id: r for r in assigned(docs, tree, hash_tree.grown(tree))}
    count = Counter(r.shard for r in before.values())
    for shard in range(12):
        assert count[shard] == pytest.approx(20_000 * weights.get(shard, 1.0) / 13.5, rel=0.12)
    moved = [r for r in before.values() if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {12} and len(moved) == pytest.approx(20_000 / 14.5, rel=0.15)
    # A heavier shard 0 draws rows into its region only, and takes none from one shard of another to the next.
    heavier = {r.doc_id: r.shard for r in assigned(docs, hash_tree.grid(12, 2, 2, {**weights, 0: 4.0}))}
    region = {0, 1, 2, 3}
    changed = [(before[i].shard, heavier[i]) for i in heavier if before[i].shard != heavier[i]]
    assert changed and all(to in region for _, to in changed)


def test_trees_need_weight():
    with pytest.raises(ValueError):
        hash_tree.Node("empty")
    with pytest.raises(ValueError):
        hash_tree.Node("light", shard=1, own_weight=0.0)


# ---- URL rules


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "http://com", "http://COM/x", "https://a.example.COM/en/1", "http://www.example.com/en/?q",
        "http://xexample.com/en/", "http://example.com/EN/", "http://x.net/es/a#b", "http://net/fr", "http://a.net/fr/", "ftp://b.org/en/",
        "http://com:80/x", "x://y://com/", "http://a.com\n/x", "http://evil.org/.com/en/", "http://user@www.example.com/en/z",
    ]
    rows = [(i, u, "html", "token") for i, u in enumerate(urls)] + [(3, "http://b.net/es/", None, None)] * 2 + [(None, "http://c.com/", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, token string")

    def plain(url):
        import re

        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(texts._LOW), m[2]) if m else ("", "")
        fits = [r for r in url_rules.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        return host, path, best and best.text, best.verdict if best else "allow"

    got = Counter(tuple(r) for r in url_rules.judge_urls(pages).collect())
    assert got == Counter((i, *plain(u)) for i, u, _, _ in rows)
    assert url_rules.judge_urls(pages.where("page_id < -1")).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(pages, (), "block").collect()} == {"block"}


def test_rules_are_looked_up_by_whole_tokens():
    assert url_rules.Rule("a-b.org", "/x/half", "block").tokens() == ["h:a", "h:b", "h:org", "p:x"]


# ---- tokens


def reference_encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_ids_equal_the_library(spark):
    encoding = reference_encoding()
    rng = random.Random(2)
    more = ["<|endoftext|>", "a" * 3000, "ab" * 2000, "\x1c\x1d", "it's  we'll\n\n x", "é" * 1500, "".join(chr(c) for c in range(0x20, 0x3000))]
    more += ["".join(rng.choice("abcdeht  .'\n1é") for _ in range(rng.randrange(300))) for _ in range(200)]
    rows = [(r[0], r[1], "x") for r in texts.rows()] + [(1000 + i, t, "x") for i, t in enumerate(more)]
    made = bpe_matrix.encode_documents(spark.createDataFrame(rows, "doc_id long, text string, ids string"), decode=True).collect()
    want = Counter((i, np.array(encoding.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for i, t, _ in rows)
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in made) == want


def test_pair_table_finds_all_and_nothing_else():
    rng = np.random.default_rng(0)
    left, right = rng.integers(0, 50_000, (2, 5000)).astype(np.int32)
    keys, first = np.unique(left.astype(np.int64) << 32 | right, return_index=True)
    left, right = left[first], right[first]
    table = bpe_matrix.PairTable(left, right, np.arange(len(left), dtype=np.int32))
    assert (table.look_up(left, right) == np.arange(len(left))).all()
    assert (table.look_up(right + 60_000, left) == 2**31 - 1).all()


# ---- fingerprints


def test_fingerprints_of_awkward_rows(spark):
    rows = fingerprints.fingerprint_edits(texts.frame(spark)).collect()
    given = [(r[0], r[1] or "") for r in texts.rows()]
    order = sorted({i for i, _ in given}, key=lambda i: -(1 << 63) if i is None else i)
    following = {i: order[(n + 1) % len(order)] for n, i in enumerate(order)}
    options = {i: {t for d, t in given if d == i} for i in order}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    possible = {
        (i, len(t), sha(t[: len(t) - len(t) // 4] + other[: len(t) // 4])): i for i, t in given for other in options[following[i]]
    }
    assert len(rows) == len(given)
    assert all((r.doc_id, r.n_chars, r.edited_sha256) in possible for r in rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    same = {r.fingerprint for r in rows if r.doc_id in (1, 3, 4)}
    assert len(same) == 1 and "" not in same
    assert {r.fingerprint for r in rows if r.doc_id in (5, 6, 7)} == {""}
    assert fingerprints.fingerprint_edits(texts.empty(spark)).count() == 0


def test_fingerprints_merge_and_estimate_containment(spark):
    part = [f"w{i}" for i in range(2000)]
    whole = part + [f"v{i}" for i in range(18_000)]
    frame = spark.createDataFrame([(" ".join(part), " ".join(whole), " ".join(whole[1996:]))], "small string, large string, rest string")
    made = frame.select(*[fingerprints.shingle_hashes(F.col(c)).alias(c) for c in frame.columns])
    row = made.select("*", fingerprints.likeness(F.col("small"), F.col("large")).alias("near")).first()
    assert row.near == 1.0
    assert sorted(set(row.small) | set(row.rest)) == list(row.large)
    assert len(row.large) == pytest.approx(20_000 / 8, rel=0.1)


# ---- language


def test_language_of_awkward_rows(spark):
    model = language_id.train(["the house and the garden " * 9, "das haus und der garten " * 9] * 20, ["en", "de"] * 20)
    rows = language_id.identify(texts.frame(spark), model).collect()
    assert len(rows) == len(texts.rows())
    for r in rows:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not has_letter)
        assert 0 <= r.score <= 1 and (has_letter or r.rejected)
    assert language_id.identify(texts.empty(spark), model).count() == 0
    none = language_id.identify(texts.frame(spark), None).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_language_is_learned_and_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify(docs, language_id.fit(docs)).where(language_id.held_out()).collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert sum(r.rejected for r in rows) / len(rows) < 0.01
    assert language_id.fit(docs.where("lang IS NULL")) is None


def test_scores_are_calibrated_enough_to_reject_noise():
    rng = random.Random(4)
    samples = {"en": "the and of house garden water people", "de": "der und das haus garten wasser leute"}
    made = [(" ".join(rng.choices(words.split(), k=rng.randrange(5, 40))), lang) for lang, words in samples.items() for _ in range(60)]
    model = language_id.train([t for t, _ in made], [lang for _, lang in made])
    raw = np.frombuffer(b"the house and the water", dtype=np.uint8)
    sure = language_id._softmax(model.logits(raw, np.array([0, len(raw)])))[0]
    assert model.languages[int(sure.argmax())] == "en" and sure.max() > 0.8


def test_every_language_is_learned(spark):
    """More languages than 500, most of one or two rows; a bound on the whole sample leaves none out."""
    rows = []
    for n in range(620):
        for copy in range(40 if n < 2 else 1 + n % 2):
            word = "".join(chr(97 + n // 26**i % 26) for i in range(3))
            rows.append((len(rows), f"{word}{word} q{word}z " * (4 + copy), f"lang{n}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = {r.lang for r in docs.where(~language_id.held_out()).select("lang").distinct().collect()}
    assert len(want) > 400
    model = language_id.fit(docs, language_id.Settings(total_rows=100, epochs=1))
    assert set(model.languages) == want
    many = spark.createDataFrame([(8 * n, f"a text of number {n}", f"lang{n}") for n in range(1500)], docs.schema).where(~language_id.held_out())
    model = language_id.fit(many, language_id.Settings(epochs=1))
    assert len(model.languages) == many.count() > 500
    assert all(r.lang_pred in model.languages for r in language_id.identify(many, model).collect())


def test_a_factored_model_gives_the_same_scores():
    rng = np.random.default_rng(1)
    embed, out, bias = rng.normal(size=(64, 3)), rng.normal(size=(3, 5)), rng.normal(size=5)
    names = tuple("abcde")
    one = language_id.Model(names, embed @ out, bias, 1.0, 0.5)
    two = language_id.Model(names, embed, bias, 1.0, 0.5, out)
    raw = np.frombuffer(b"the house and the water", dtype=np.uint8)
    starts = np.array([0, 9, 9, len(raw)])
    assert np.allclose(one.logits(raw, starts), two.logits(raw, starts))
    assert all(np.allclose(a, b) for a, b in zip(one.best(raw, starts), two.best(raw, starts)))


# ---- toxicity


def test_toxicity_of_awkward_rows(spark):
    model = toxicity.train(["you idiot fool", "nice day", "an idiot here", "good words"] * 10, [1, 0, 1, 0] * 10)
    rows = toxicity.score_documents(texts.frame(spark), model).collect()
    assert len(rows) == len(texts.rows())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.score_documents(texts.empty(spark), model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(texts.frame(spark), labels).bias == 0.0


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score_documents(docs.select("doc_id", "text"), toxicity.fit(docs, labels), keep=["doc_id"])
    rows = scored.join(labels, "doc_id").where(toxicity.held_out()).collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.75
    assert sum(r.predicted for r in clean) / len(clean) < 0.01


def test_swapped_groups_score_alike():
    """Toxic texts that mostly name one group: without the penalty, naming it raises the score."""
    rng = random.Random(1)
    filler = [f"f{i}" for i in range(40)]
    made, label = [], []
    for i in range(600):
        toxic = i % 2
        words = rng.choices(filler, k=8) + (["vile"] if toxic and rng.random() < 0.7 else [])
        group = ("muslims" if rng.random() < 0.8 else "christians") if toxic else ("christians" if rng.random() < 0.8 else "muslims")
        made.append(" ".join([*words, group]))
        label.append(toxic)

    def gap(model):
        raw = [f"some {g} live in this town".encode() for g in ("muslims", "christians")]
        data, starts = np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)])
        first, second = model.scores(data, starts)
        return abs(first - second)

    plain = toxicity.train(made, label, settings=toxicity.Settings(counterfactual=0.0))
    fair = toxicity.train(made, label)
    assert gap(plain) > 0.3 and gap(fair) < gap(plain) / 3


# ---- mix


def test_mix_of_awkward_rows(spark):
    mix = mixing.Mix(domains={"a": ["src0"], "b": ["src1"]}, domain_weights={"a": 3}, share=50)
    rows = mixing.mix_documents(texts.frame(spark), mix).collect()
    given = Counter((r[0], r[1]) for r in texts.rows())
    assert all((r.doc_id, r.text) in given and r.text for r in rows)
    assert {r._mix.domain for r in rows} <= {"a", "b", "other"}
    total = sum(-(-len(t.encode()) // 4) * n for (_, t), n in given.items() if t)
    assert sum(r._mix.tokens for r in rows) <= total * mix.share // 100
    assert mixing.mix_documents(texts.empty(spark), mix).count() == 0


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = [("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 1000), ("b", "x", "s4", 1000)]
    frame = spark.createDataFrame(leaves, "domain string, language string, leaf_source string, tokens long")
    found = {r.leaf_source: r.budget for r in mixing.budgets(frame, mixing.Mix(share=40, epochs=1)).collect()}
    # 1204 tokens: 602 a domain, 301 a language of a; s1 can take 10, its sibling s2 takes the other 291.
    assert found == {"s1": 10, "s2": 291, "s3": 301, "s4": 602}
    small = [("a", "x", "s1", 10), ("a", "y", "s2", 20), ("b", "x", "s3", 5000)]
    frame = spark.createDataFrame(small, "domain string, language string, leaf_source string, tokens long")
    found = {r.leaf_source: r.budget for r in mixing.budgets(frame, mixing.Mix(share=50, epochs=2)).collect()}
    assert found == {"s1": 20, "s2": 40, "s3": 2455}


# ---- rollups


def change(kind, tokens, old=None, source="s", lang="en", tokenizer="t"):
    return (kind, source, lang, tokenizer, tokens, old)


CHANGES = "change string, source string, lang string, tokenizer string, tokens long, old_tokens long"


def held(spark, root):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in token_rollup.totals(spark, root).collect()}


def test_rollups_add_up_and_commit_once(spark):
    root = scratch_path(spark, "rollup-test")
    assert held(spark, root) == {}
    commit = lambda name, *rows: token_rollup.commit_batch(root, name, spark.createDataFrame(rows, CHANGES))
    assert commit("1", change("insert", 10), change("insert", 5, source=None), change("insert", 7))
    assert commit("a/b", change("revise", 4, 10), change("delete", 7))
    assert held(spark, root) == {("s", "en", "t"): (1, 4), (None, "en", "t"): (1, 5)}
    assert not commit("1", change("insert", 10))
    assert commit("empty")
    assert commit("3", change("delete", 5, source=None), change("insert", None))
    assert held(spark, root) == {("s", "en", "t"): (2, 4)}
    with pytest.raises(Exception, match="unknown change"):
        commit("4", change("replace", 1))
    assert held(spark, root) == {("s", "en", "t"): (2, 4)}


def test_a_written_delta_counts_only_once_committed(spark):
    root = scratch_path(spark, "rollup-test")
    rows = spark.createDataFrame([change("insert", 3)], CHANGES)
    delta = token_rollup.signed(rows)
    # A job that wrote its delta and died, or ran twice, leaves files without a commit.
    delta.withColumn("batch", F.lit("x")).withColumn("attempt", F.lit("lost")).write.parquet(f"{root}/deltas/lost")
    assert held(spark, root) == {}
    assert token_rollup.commit_batch(root, "x", rows)
    assert not token_rollup._write(delta, root, "x")
    assert held(spark, root) == {("s", "en", "t"): (1, 3)}


def empty_file(spark, path):
    files, where = token_rollup._files(spark, path)
    files.create(where, False).close()


def test_an_empty_commit_is_none(spark):
    root = scratch_path(spark, "rollup-test")
    rows = spark.createDataFrame([change("insert", 3)], CHANGES)
    # A writer that died between creating its commit and writing it.
    empty_file(spark, f"{root}/commits/{token_rollup._name('x')}.json")
    assert held(spark, root) == {}
    assert token_rollup.commit_batch(root, "x", rows)
    assert not token_rollup.commit_batch(root, "x", rows)
    assert held(spark, root) == {("s", "en", "t"): (1, 3)}


def test_of_two_writers_one_commits(spark):
    root = scratch_path(spark, "rollup-test")
    path = f"{root}/commits/{token_rollup._name('x')}.json"
    assert [token_rollup._publish(spark, path, str(i)) for i in range(3)] == [True, False, False]
    assert spark.read.text(path).first()[0] == "0"
    files, where = token_rollup._files(spark, f"{root}/commits")
    assert [f.getPath().getName() for f in files.listStatus(where)] == [path.rsplit("/", 1)[1]]


def test_folding_changes_no_total(spark, monkeypatch):
    root = scratch_path(spark, "rollup-test")
    batch = lambda name, *rows: token_rollup.commit_batch(root, name, spark.createDataFrame(rows, CHANGES))
    assert token_rollup.fold(spark, root) == 0
    batch("1", change("insert", 10), change("insert", 5, source=None))
    batch("2", change("insert", 7))
    before = held(spark, root)
    # A fold that dies before it is published leaves the totals alone.
    with monkeypatch.context() as patch:
        patch.setattr(token_rollup, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            token_rollup.fold(spark, root)
    assert held(spark, root) == before
    assert token_rollup.fold(spark, root) == 2 and held(spark, root) == before
    assert token_rollup.fold(spark, root) == 0
    assert not batch("1", change("insert", 10))
    batch("3", change("delete", 5, source=None), change("revise", 1, 7))
    want = {("s", "en", "t"): (2, 11)}
    assert held(spark, root) == want
    assert token_rollup.fold(spark, root) == 1 and held(spark, root) == want
    # What is folded is not read again.
    files, where = token_rollup._files(spark, f"{root}/deltas")
    files.delete(where, True)
    assert held(spark, root) == want


def test_corpus_batches_of_awkward_rows(spark):
    root = scratch_path(spark, "rollup-test")
    for name, rows in token_rollup.corpus_batches(texts.frame(spark)).items():
        token_rollup.commit_batch(root, name, rows)
    low = {}
    given = [(-(1 << 63) if r[0] is None else r[0], r[1] or "", r[3], r[2]) for r in texts.rows()]
    for i, t, _, _ in given:
        low[t] = min(i, low.get(t, i))
    want = {}
    for i, t, source, lang in given:
        if i == low[t]:
            for name, n in (("words-1", len(texts.WORD.findall(t))), ("bytes4-1", -(-len(t.encode()) // 4))):
                docs, tokens = want.get((source, lang, name), (0, 0))
                want[source, lang, name] = (docs + 1, tokens + n)
    assert held(spark, root) == want
