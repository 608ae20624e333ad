"""Language identification by averaged hashed subword embeddings and a linear softmax.

Texts are read as bytes: ASCII letters are lower-cased, every other ASCII byte is a gap.
The subwords of a text are its runs of three and four bytes that hold a letter, hashed
into a fixed number of buckets. The mean of their embeddings goes through a linear
softmax. Embeddings and softmax are trained by stochastic gradient descent in numpy on
a bounded sample of labelled texts and of short passages of them. A temperature fitted
on texts left out of training makes scores probabilities, and the smallest score that
keeps accepted texts right often enough becomes the limit of rejection.
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

UNKNOWN = "und"
# Texts times languages that are judged at a time.
_CELLS = 1 << 22
_FOLD = np.full(256, 32, dtype=np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Settings:
    """Training parameters.

    ``per_language`` bounds the sample of labelled texts of each language, ``total_rows`` and ``total_bytes`` bound
    all of it: they are shared evenly, so many languages get fewer texts each, but every one at least one.
    """

    per_language: int = 300
    total_rows: int = 150_000
    total_bytes: int = 64 << 20
    bits: int = 14
    dims: int = 16
    epochs: int = 3
    rate: float = 0.5
    seed: int = 7
    right_share: float = 0.95
    least_limit: float = 0.3


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # bucket x language: embedding times softmax weights; with more languages than dimensions the embedding
    bias: np.ndarray
    temperature: float
    limit: float
    out: np.ndarray | None = None  # dimension x language: the softmax weights, if not in the table

    def logits(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        buckets, rows = subwords(data, starts, (len(self.table) // 2).bit_length() - 1)
        n_rows = len(starts) - 1
        sums = np.stack([np.bincount(rows, self.table[buckets, j], n_rows) for j in range(self.table.shape[1])], axis=1)
        count = np.bincount(rows, minlength=n_rows)
        mean = sums / np.maximum(count, 1)[:, None]
        return ((mean if self.out is None else mean @ self.out) + self.bias) / self.temperature

    def best(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(language, chance)`` of every text, a bounded table of texts by languages at a time."""
        n, step = len(starts) - 1, max(1, _CELLS // max(1, len(self.languages)))
        names, chances = [np.zeros(0, np.int64)], [np.zeros(0)]
        for at in range(0, n, step):
            part = starts[at : min(n, at + step) + 1]
            chance = _softmax(self.logits(data[part[0] : part[-1]], part - part[0]).astype(np.float64))
            names.append(chance.argmax(axis=1))
            chances.append(chance.max(axis=1))
        return np.concatenate(names), np.concatenate(chances)


def subwords(data: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bucket, row)`` of all subwords; runs of three use the first half of the buckets, runs of four the second."""
    n = len(data)
    row_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    low = _FOLD[data]
    gap = low == 32
    out, rows = [], []
    for size in (3, 4):
        m = n - size + 1
        if m <= 0:
            continue
        code = low[:m] | (low[1 : m + 1] << np.uint32(8)) | (low[2 : m + 2] << np.uint32(16))
        if size == 4:
            code = code | (low[3 : m + 3] << np.uint32(24))
        # Inside one text, and with a letter in second place.
        keep = (row_of[:m] == row_of[size - 1 :]) & ~gap[1 : m + 1]
        hashed = (code[keep] * np.uint32(2654435761)) >> np.uint32(32 - bits)
        out.append(hashed.astype(np.int32) + (size == 4) * (1 << bits))
        rows.append(row_of[:m][keep])
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(rows)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _bags(texts: list[str], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its different buckets and their shares."""
    bags = []
    for first, end, data, starts in wa.slices(pa.array(texts, pa.string())):
        buckets, rows = subwords(data, starts, bits)
        order = np.argsort(rows, kind="stable")
        parts = np.split(buckets[order], np.cumsum(np.bincount(rows, minlength=end - first))[:-1])
        for part in parts:
            found, count = np.unique(part, return_counts=True)
            bags.append((found, (count / max(1, len(part))).astype(np.float32)))
    return bags


def train(texts: list[str], languages: list[str], settings: Settings = Settings()) -> Model:
    """Fit a model; a fifth of the texts is kept for temperature and limit."""
    names = tuple(sorted(set(languages)))
    number = {name: i for i, name in enumerate(names)}
    label = np.array([number[x] for x in languages], dtype=np.int64)
    rng = np.random.default_rng(settings.seed)
    # Short passages beside the whole texts, so that scores of short texts are honest too.
    passages, whose = [], []
    for i, text in enumerate(texts):
        words = text.split()
        if len(words) > 4:
            size = int(rng.integers(2, 21))
            at = int(rng.integers(0, max(1, len(words) - size)))
            passages.append(" ".join(words[at : at + size]))
            whose.append(i)
    bags = _bags(texts + passages, settings.bits)
    label = np.concatenate((label, label[np.array(whose, dtype=np.int64)]))
    left_out = np.concatenate((np.arange(len(texts)), np.array(whose, dtype=np.int64))) % 5 == 4
    # A language is never left out as a whole.
    left_out &= np.bincount(label[~left_out], minlength=len(names))[label] > 0
    use = np.flatnonzero(~left_out)
    embed = rng.normal(0, 0.3, (2 << settings.bits, settings.dims)).astype(np.float32)
    out = rng.normal(0, 0.3, (settings.dims, len(names))).astype(np.float32)
    bias = np.zeros(len(names), dtype=np.float32)
    steps, done = settings.epochs * max(1, len(use)), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(use):
            found, share = bags[i]
            rate = np.float32(settings.rate * (1 - done / steps))
            done += 1
            if not len(found):
                continue
            mean = share @ embed[found]
            error = _softmax(mean @ out + bias)
            error[label[i]] -= 1
            back = out @ error
            out -= rate * np.outer(mean, error)
            bias -= rate * error * np.float32(0.1)
            embed[found] -= (rate * 20) * np.outer(share, back)
    check = np.flatnonzero(left_out) if left_out.any() else use
    factored = len(names) > settings.dims
    table = embed if factored else (embed @ out).astype(np.float32)
    means = np.array([share @ table[found] for found, share in (bags[i] for i in check)]).reshape(-1, table.shape[1])
    truth = label[check]
    step = max(1, _CELLS // max(1, len(names)))
    parts = [slice(at, at + step) for at in range(0, len(check), step)]
    logits = lambda part: (means[part] @ out if factored else means[part]) + bias
    cold = np.geomspace(0.05, 20, 60)
    loss = np.zeros(len(cold))
    for part in parts:
        z, own = logits(part), truth[part]
        loss += [-np.log(_softmax(z / t)[np.arange(len(own)), own] + 1e-12).sum() for t in cold]
    temperature = float(cold[int(np.argmin(loss))])
    score, right = np.zeros(len(check)), np.zeros(len(check), dtype=bool)
    for part in parts:
        best = _softmax(logits(part) / temperature)
        score[part], right[part] = best.max(axis=1), best.argmax(axis=1) == truth[part]
    limit = settings.least_limit
    for limit in np.linspace(settings.least_limit, 0.95, 56):
        taken = score >= limit
        if not taken.any() or right[taken].mean() >= settings.right_share:
            break
    return Model(names, table, bias, temperature, float(limit), out if factored else None)


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2):
    """Rows that never take part in learning; a null doc_id is none of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Train on a bounded sample of the labelled rows that are not held out; None without any label.

    The sample takes at most about ``per_language`` rows of each language, by a hash of doc_id and text, and fewer
    where ``total_rows`` or ``total_bytes`` shared among all languages are less. Every language with a row has at
    least one in it, so with more languages than ``total_rows`` the sample holds one row of each.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out())
    key = F.xxhash64("doc_id", F.substring("text", 1, 64))
    draw = F.pmod(key, F.lit(1 << 20))
    counts = rows.groupBy("lang").agg(
        F.count("*").alias("n"), F.avg(F.octet_length("text")).alias("bytes"), F.min(F.struct(draw, key)).alias("first")
    )
    counts = materialise(counts, "languages")
    languages = max(1, counts.count())
    want = F.least(
        F.lit(float(settings.per_language)), F.lit(settings.total_rows / languages), F.lit(settings.total_bytes / languages) / F.col("bytes")
    )
    # The first row by draw is in whatever the share is.
    drawn = (draw < F.ceil(want * (1 << 20) / F.col("n"))) | F.struct(draw, key).eqNullSafe(F.col("first"))
    sample = rows.join(counts, "lang").where(drawn)
    found = sample.select("doc_id", "lang", "text").orderBy("lang", "doc_id", "text").toPandas()
    if not len(found):
        return None
    model = train(found["text"].tolist(), found["lang"].tolist(), settings)
    del found
    wa.give_back()
    return model


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, scores = [], []
        letters = batch.column(batch.schema.get_field_index("_letters")).to_numpy(zero_copy_only=False)
        at = batch.schema.get_field_index("_text")
        for first, end, data, starts in wa.slices(batch.column(at)):
            if model is None:
                names += [UNKNOWN] * (end - first)
                scores.append(np.zeros(end - first))
                continue
            language, chance = model.best(data, starts)
            some = letters[first:end].astype(bool)
            names += [model.languages[j] if ok else UNKNOWN for j, ok in zip(language.tolist(), some.tolist())]
            scores.append(np.where(some, chance, 0.0))
        scores = np.concatenate(scores) if scores else np.zeros(0)
        limit = 2.0 if model is None else model.limit
        kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in ("_letters", "_text")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(names, pa.string()), pa.array(scores), pa.array(scores < limit)],
            names=[str(i) for i in range(len(kept) + 3)],
        )


def identify(docs: DataFrame, model: Model | None, keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred string, score double, rejected boolean`` to the ``keep`` columns (all, if None) of ``docs``.

    Whole texts are read. A text that is null, empty or has no letter is ``und`` with score 0 and
    rejected; so is every text if there is no model. Otherwise the score is the calibrated
    probability of the best language (ties: the first by name), and texts below the
    model's limit are rejected. Null and repeated doc_ids pass through; columns of ``docs``
    with the names of new ones are replaced.
    """
    wa.short_batches(docs.sparkSession)
    new = {"lang_pred", "score", "rejected"}
    keep = [c for c in (keep or docs.columns) if c not in new]
    text = F.col("text").cast("string")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], text.alias("_text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(lambda batches: wa.returning(_predict(batches, model)), schema)
