"""Toxicity classifier with counterfactual regularisation.

A text is the set of its words and of their first few bytes (hashed); a logistic regression
scores it. In training every
labelled text that names a group gets a counterfactual: each identity term is swapped for
another of the same kind. Besides the label's loss, the squared change of the score
between a text and its counterfactual is penalised, so that naming a group does
not by itself raise the score. Training is stochastic gradient descent in numpy with
adaptive rates and a sparsity penalty, on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomvec.llm import wordarrays as wa
from loomvec.session import materialise

# Terms that name groups of people, by kind; a term is swapped for one of the same line.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("mexican", "american", "chinese", "indian", "german", "french", "spanish"),
    ("deaf", "blind", "disabled", "elderly", "young"),
)


# Bytes of sampled texts whose features the driver holds at once.
TRAINED_AT_ONCE = 1 << 17

# Sizes in bytes of the beginnings of words that are features beside the whole words.
HEADS = (4, 5, 6, 7, 8)


@dataclass(frozen=True)
class Settings:
    """``toxic_rows``, ``clean_rows`` and ``total_bytes`` (of text) bound the labelled rows that training sees."""

    toxic_rows: int = 2000
    clean_rows: int = 3000
    total_bytes: int = 64 << 20
    bits: int = 18
    epochs: int = 12
    batch: int = 128
    rate: float = 0.2
    sparsity: float = 3e-4
    counterfactual: float = 20.0
    least_texts: int = 3
    least_effect: float = 2.5
    seed: int = 11


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        buckets, rows = features(data, starts, len(self.weights).bit_length() - 1)
        z = self.bias + np.bincount(rows, self.weights[buckets], len(starts) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def features(data: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bucket, row)`` of the different words, and beginnings of longer words, of each text."""
    hashes, rows = wa.words(data, starts, wa.NOT_ALNUM, HEADS)
    return wa.distinct((hashes >> np.uint64(64 - bits)).astype(np.int64), rows)


def _word_buckets(word: str, bits: int) -> np.ndarray:
    """Buckets of a word and of its beginnings, the whole word first."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return (wa.words(raw, np.array([0, len(raw)]), wa.NOT_ALNUM, HEADS)[0] >> np.uint64(64 - bits)).astype(np.int64)


def swaps(bits: int, terms=IDENTITY_TERMS) -> dict[int, tuple[np.ndarray, list[np.ndarray]]]:
    """By each identity term's bucket: all buckets of the term, and those of the terms it may be swapped for."""
    out: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}
    for line in terms:
        own = [_word_buckets(w, bits) for w in line]
        for i, buckets in enumerate(own):
            out[int(buckets[0])] = (buckets, [b for j, b in enumerate(own) if j != i])
    return out


def train(texts: list[str], toxic: list[int], prior: float | None = None, settings: Settings = Settings(), terms=IDENTITY_TERMS) -> Model:
    """Fit on labelled texts. ``prior`` is the share of toxic rows where texts are scored, if not that of ``toxic``."""
    rng = np.random.default_rng(settings.seed)
    y = np.array(toxic, dtype=np.float64)
    size = 1 << settings.bits
    column = pa.array(texts, pa.string())
    # Only features whose texts differ clearly from the sample in their share of toxic ones take part.
    seen, bad = np.zeros(size), np.zeros(size)
    for first, end, data, starts in wa.slices(column, TRAINED_AT_ONCE):
        buckets, rows = features(data, starts, settings.bits)
        seen += np.bincount(buckets, minlength=size)
        bad += np.bincount(buckets, y[first:end][rows], size)
    share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    effect = np.abs(bad - seen * share) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    swap = swaps(settings.bits, terms)
    known = (seen >= settings.least_texts) & (effect >= settings.least_effect)
    known[np.concatenate([buckets for buckets, _ in swap.values()])] = True
    terms_at = np.zeros(size, dtype=bool)
    terms_at[list(swap)] = True
    bags: list[np.ndarray] = []
    for first, end, data, starts in wa.slices(column, TRAINED_AT_ONCE):
        buckets, rows = features(data, starts, settings.bits)
        buckets, rows = buckets[known[buckets]], rows[known[buckets]]
        bags += np.split(buckets.astype(np.int32), np.cumsum(np.bincount(rows, minlength=end - first))[:-1])
    weights, square = np.zeros(size), np.full(size, 1e-6)
    bias, bias_square = float(np.log(share / (1 - share))), 1e-6
    for _ in range(settings.epochs if 0 < y.sum() < len(y) else 0):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), settings.batch):
            rows = order[at : at + settings.batch]
            plain = [bags[i] for i in rows]
            twin_of, twins = [], []
            for k, bag in enumerate(plain):
                named = bag[terms_at[bag]]
                if len(named):
                    old, new = [], []
                    for own, others in (swap[b] for b in named.tolist()):
                        old.append(own)
                        new.append(others[rng.integers(len(others))])
                    rest = np.setdiff1d(bag, np.concatenate(old))
                    twins.append(np.unique(np.concatenate((rest, *new))))
                    twin_of.append(k)
            held = plain + twins
            ends = np.cumsum([len(b) for b in held])
            flat, owner = np.concatenate(held), np.repeat(np.arange(len(held)), np.diff(ends, prepend=0))
            p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(owner, weights[flat], len(held)), -30, 30)))
            error = np.zeros(len(held))
            error[: len(plain)] = p[: len(plain)] - y[rows]
            if twins:
                k, t = np.array(twin_of), np.arange(len(plain), len(held))
                change = 2 * settings.counterfactual * (p[k] - p[t])
                error[k] += change * p[k] * (1 - p[k])
                error[t] -= change * p[t] * (1 - p[t])
            touched, where = np.unique(flat, return_inverse=True)
            gradient = np.bincount(where, error[owner]) / len(plain)
            square[touched] += gradient**2
            step = settings.rate / np.sqrt(square[touched])
            moved = weights[touched] - step * gradient
            weights[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * settings.sparsity, 0)
            slope = error[: len(plain)].mean()
            bias_square += slope**2
            bias -= settings.rate / np.sqrt(bias_square) * slope
    if prior is not None and len(y):
        prior = min(max(prior, 1e-3), 1 - 1e-3)
        bias += float(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    return Model(weights.astype(np.float32), bias)


def held_out(doc_id: str = "doc_id", parts: int = 5, part: int = 0):
    """Rows whose labels are never learned; a null doc_id is none of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on a bounded sample of labelled rows that are not held out.

    A doc_id with several labels counts as toxic if one says so; null labels and unknown doc_ids are
    left out. Each class is thinned by a hash of doc_id to about the bound of ``settings``. Without
    both classes the model is the constant share of toxic rows (0.5 without any).
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic is not null").where(~held_out())
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bound = {1: settings.toxic_rows, 0: settings.clean_rows}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    cut = F.lit(0)
    for toxic, rows in n.items():
        cut = F.when(F.col("toxic") == toxic, F.lit(-(-(bound[toxic] << 20) // rows))).otherwise(cut)
    sample = materialise(known.where(draw < cut), "labelled")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = sample.join(texts, "doc_id").select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    found = materialise(found, "labelled-texts")
    size = found.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > settings.total_bytes:
        again = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 20))
        found = found.where(again < (settings.total_bytes << 20) // size)
    found = found.orderBy("doc_id", "text").toPandas()
    total = sum(n.values())
    texts_of, toxic = found["text"].tolist(), found["toxic"].tolist()
    del found
    model = train(texts_of, toxic, n.get(1, 0) / total if total else None, settings)
    del texts_of
    wa.give_back()
    return model


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [model.scores(data, starts) for _, _, data, starts in wa.slices(batch.column(batch.num_columns - 1))]
        score = np.concatenate(parts) if parts else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
            names=[str(i) for i in range(batch.num_columns + 1)],
        )


def score_documents(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Add ``score double, predicted int`` to the ``keep`` columns (all, if None) of ``docs``.

    The whole text is scored; null and empty texts get the score of no words. Every row is scored by
    its text alone, so equal texts have equal scores. Null and repeated doc_ids pass through;
    columns of ``docs`` with the names of new ones are replaced.
    """
    wa.short_batches(docs.sparkSession)
    keep = [c for c in (keep or docs.columns) if c not in ("score", "predicted")]
    own = docs.select(*[F.col(f"`{c}`") for c in keep])
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("_text"))
    schema = own.schema.add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(lambda batches: wa.returning(_score(batches, model)), schema)
