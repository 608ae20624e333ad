"""Threshold-scaled fingerprints: every shingle hash below a fixed fraction of the hash range.

Which hashes are kept depends on the hash alone, so the fingerprint of a union is the union of
fingerprints, and containment of a small text in a large one can be estimated from both. A
text without a hash below the threshold keeps its smallest one, so no text with a word is without
a fingerprint. Built-in functions only: texts never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomvec.operators.ordering import with_positions
from loomvec.session import materialise

WORDS = 5
# Share of the hash range that is kept.
FRACTION = 1 / 8
_FIRST = -(1 << 63)


def shingle_hashes(text: Column, words: int = WORDS, fraction: float = FRACTION) -> Column:
    """The sorted distinct kept hashes of a text's word shingles; an empty array without a word.

    Words are runs between white space, A-Z lower-cased; fewer than ``words`` words are one shingle.
    """
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = F.filter(F.split(low, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashed = F.transform(parts, lambda w: F.xxhash64(w))

    def over(codes: Column) -> Column:
        n = F.size(codes)
        runs = F.transform(
            F.sequence(F.lit(1), n - (words - 1)),
            lambda i: F.xxhash64(*[F.get(codes, i + (k - 1)) for k in range(words)]),
        )
        return F.when(n == 0, F.array().cast("array<long>")).when(n < words, F.array(F.xxhash64(codes))).otherwise(runs)

    def kept(every: Column) -> Column:
        below = F.filter(every, lambda h: (h >= 0) & (h < int(fraction * (1 << 64))))
        return F.when((F.size(below) == 0) & (F.size(every) > 0), F.array(F.array_min(every))).otherwise(below)

    return F.array_sort(F.array_distinct(_with(_with(hashed, over), kept)))


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def likeness(a: Column, b: Column) -> Column:
    """Estimated containment of the smaller shingle set in the larger; 1 if both are empty, 0 if one is."""
    shared = F.size(F.array_intersect(a, b))
    small = F.least(F.size(a), F.size(b))
    both = F.greatest(F.size(a), F.size(b)) == 0
    return F.when(both, F.lit(1.0)).when(small == 0, F.lit(0.0)).otherwise(shared / small).cast("double")


def printed(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), ".")


def neighbours(ids: DataFrame, key: str) -> DataFrame:
    """``(key, next_key)`` of distinct keys in ascending order; the last one's next is the first."""
    placed = with_positions(ids.select(key).distinct(), [], [key], "at", stage=True)
    placed = materialise(placed, "order")
    following = placed.select(F.col(key).alias("next_key"), (F.col("at") - 1).alias("at"))
    n = placed.agg(F.max("at")).first()[0] or 0
    return placed.withColumn("at", F.pmod("at", F.lit(max(n, 1)))).join(following, "at").select(key, "next_key")


def fingerprint_edits(docs: DataFrame, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of texts and of their edited forms, one row per row of ``docs (doc_id, text, ...)``.

    Returns ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``. The
    edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of
    the next document's, by ascending doc_id; the last one's next is the first. A null text is empty; a null
    doc_id sorts first. Rows that repeat a doc_id share their next document, and where that one is
    repeated it is the row with the smallest text hash. Texts without a word have an empty fingerprint. Other
    columns of any name are ignored.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST))
    # Only key and text, so that both joins below use one and the same shuffle of the texts.
    rows = docs.select(key.alias("k"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = rows.select("k", F.char_length("text").cast("long").alias("n"), F.xxhash64("text").alias("h"))
    ids = materialise(ids.groupBy("k").agg(F.max("n").alias("n"), F.min("h").alias("h")), "ids")
    chain = neighbours(ids, "k")
    # What each document sends to the one before it: its fingerprint, and as much of its text as any of
    # that one's rows can take.
    wanted = chain.join(ids.select("k", "n"), "k").select(
        F.col("next_key").alias("k"), F.col("k").alias("to"), F.floor(F.col("n") / 4).cast("int").alias("need")
    ).join(ids.select("k", "h"), "k")
    wanted = materialise(wanted, "wanted")
    # Written so that it is no join key, which would need a shuffle of its own.
    is_chosen = F.xxhash64("text").bitwiseXOR(F.col("h")) == 0
    sent = rows.join(wanted, "k").where(is_chosen).select(
        F.col("to").alias("k"),
        F.substring("text", F.lit(1), F.col("need")).alias("head"),
        shingle_hashes(F.col("text"), words, fraction).alias("next"),
    )
    sent = sent.groupBy("k").agg(F.first("head").alias("head"), F.first("next").alias("next"))
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("head", F.lit(1), cut))
    made = rows.join(sent, "k").select("k", "text", "next", F.explode(F.array(edited)).alias("edited"))
    prints = F.struct(
        shingle_hashes(F.col("text"), words, fraction).alias("own"),
        shingle_hashes(F.col("edited"), words, fraction).alias("edited"),
    )
    made = made.select(
        F.nullif("k", F.lit(_FIRST)).alias("doc_id"), n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), "next", F.explode(F.array(prints)).alias("p"),
    )
    return made.select(
        "doc_id", "n_chars", "edited_sha256",
        printed(F.col("p.own")).alias("fingerprint"), printed(F.col("p.edited")).alias("edited_fingerprint"),
        likeness(F.col("p.own"), F.col("p.edited")).alias("near_edited"),
        likeness(F.col("p.own"), F.col("next")).alias("near_next"),
    )
