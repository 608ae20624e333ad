"""Cleaning, token counts, buckets, batches and resume over the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomvec.functions import lengths, text
from loomvec.operators import batching
from loomvec.operators.embed import prepare_texts
from loomvec.operators.membership import Limits
from loomvec.operators.resume import resume_pending
from loomvec.plans.catalog.registry import (
    CLEAN_DOCUMENTS_SQL,
    clean_text_sql,
    documents,
    estimate_tokens_sql,
    query,
    squeeze_white_sql,
    strip_markers_sql,
    strip_urls_sql,
    table,
)


@query(CLEAN_DOCUMENTS_SQL)
def clean_text(spark, sf_dir):
    return prepare_texts(documents(spark, sf_dir))


@query(f"""
    SELECT page_id, {strip_urls_sql("url")} AS url, {strip_urls_sql("html")} AS html FROM pages""")
def strip_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.strip_urls(F.col("url")).alias("url"),
        text.strip_urls(F.col("html")).alias("html"),
    )


@query(f"SELECT doc_id, {strip_markers_sql('text')} AS text FROM documents")
def strip_markers(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_markers(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {squeeze_white_sql('text')} AS text FROM documents")
def squeeze_white(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.squeeze_white(F.col("text")).alias("text"))


@query("SELECT doc_id, substring(text, 1, 1000) AS text FROM documents")
def cap_chars(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.cap_chars(F.col("text")).alias("text"))


@query("SELECT doc_id, text FROM documents UNION ALL SELECT doc_id, '' FROM documents")
def blank_if_null(spark, sf_dir):
    """Every text once as it is and once null."""
    both = F.explode(F.array("text", F.lit(None).cast("string")))
    rows = table(spark, sf_dir, "documents").select("doc_id", both.alias("text"))
    return rows.select("doc_id", text.blank_if_null(F.col("text")).alias("text"))


@query("SELECT conv_id, turn, text FROM conversations WHERE text <> ''")
def drop_empty_text(spark, sf_dir):
    """Every turn as it is, empty and null; the last two have to go."""
    three = F.explode(F.array("text", F.lit(""), F.lit(None).cast("string")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", three.alias("text"))
    return rows.where(text.has_text(F.col("text")))


@query(f"""
    SELECT id, text FROM (
      SELECT CAST(page_id AS VARCHAR) AS id, {clean_text_sql("unnest([html, ' #' || url])")} AS text
      FROM pages) WHERE text <> ''""")
def drop_empty_after_clean(spark, sf_dir):
    """Every page's body, and its marked URL, which cleans to nothing."""
    both = F.explode(F.array("html", F.concat(F.lit(" #"), F.col("url"))))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), both.alias("text"))
    return prepare_texts(pages)


@query("""
    SELECT conv_id || '-' || turn AS id, text FROM conversations WHERE text <> ''""")
def prepare_uncleaned(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "text"
    )
    return prepare_texts(turns, clean=False)


@query(f"SELECT doc_id, {estimate_tokens_sql('text')} AS n_tokens FROM documents")
def estimate_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.estimate_tokens(F.col("text")).alias("n_tokens")
    )


@query(f"""
    SELECT id, array_to_string(string_split(text, ' ')[1:64], ' ') AS text
    FROM ({CLEAN_DOCUMENTS_SQL})""")
def truncate_tokens(spark, sf_dir):
    cleaned = prepare_texts(documents(spark, sf_dir))
    return cleaned.select("id", text.truncate_tokens(F.col("text"), 64).alias("text"))


def _sized(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", "source", text.estimate_tokens(F.col("text")).alias("n_tokens")
    )


_SIZED_SQL = f"SELECT doc_id, source, {estimate_tokens_sql('text')} AS n_tokens FROM documents"


def _bucket_sql(side: int) -> str:
    cases = " ".join(
        f"WHEN n_tokens BETWEEN {bounds[0]} AND {bounds[1]} THEN {bounds[side]}"
        for bounds in lengths.LENGTH_BUCKETS
    )
    return f"CASE {cases} ELSE {lengths.OVERFLOW_BUCKET[side]} END"


@query(f"""
    SELECT doc_id, n_tokens, {_bucket_sql(0)} AS bucket_lo, {_bucket_sql(1)} AS bucket_hi
    FROM ({_SIZED_SQL})""")
def length_bucket(spark, sf_dir):
    n_tokens = F.col("n_tokens")
    return _sized(spark, sf_dir).select(
        "doc_id",
        "n_tokens",
        lengths.bucket_low(n_tokens).alias("bucket_lo"),
        lengths.bucket_high(n_tokens).alias("bucket_hi"),
    )


@query(f"""
    SELECT {_bucket_sql(0)} AS bucket_lo, {_bucket_sql(1)} AS bucket_hi,
           count(*) AS docs, CAST(sum(n_tokens) AS BIGINT) AS tokens
    FROM ({_SIZED_SQL}) GROUP BY ALL""")
def bucket_counts(spark, sf_dir):
    return batching.bucket_counts(_sized(spark, sf_dir))


@query("""
    SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 100 AS BIGINT) AS chunk
    FROM documents""")
def assign_chunks(spark, sf_dir):
    return batching.assign_chunks(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 100)


@query("""
    SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 32 AS BIGINT) AS batch
    FROM documents""")
def plain_batches(spark, sf_dir):
    return batching.assign_batches(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 32)


@query("""
    SELECT lang, doc_id,
           CAST((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 32 AS BIGINT) AS batch
    FROM documents""")
def assign_batches(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id")
    return batching.assign_batches(docs, ["doc_id"], 32, within=["lang"])


_BUCKETED_SQL = f"""
    SELECT doc_id, n_tokens, bucket_lo, bucket_hi,
           CAST((row_number() OVER (PARTITION BY bucket_lo ORDER BY doc_id) - 1) // 32 AS BIGINT) AS batch
    FROM (SELECT doc_id, n_tokens, {_bucket_sql(0)} AS bucket_lo, {_bucket_sql(1)} AS bucket_hi
          FROM ({_SIZED_SQL}))"""


@query(_BUCKETED_SQL)
def bucketed_batches(spark, sf_dir):
    return batching.bucketed_batches(_sized(spark, sf_dir).drop("source"), ["doc_id"])


@query(f"""
    SELECT bucket_lo, batch, docs,
           row_number() OVER (ORDER BY md5('42:' || bucket_lo || ':' || batch)) AS turn
    FROM (SELECT bucket_lo, batch, count(*) AS docs FROM ({_BUCKETED_SQL}) GROUP BY ALL)""")
def shuffled_batches(spark, sf_dir):
    batches = batching.bucketed_batches(_sized(spark, sf_dir).drop("source"), ["doc_id"])
    return batching.shuffled_batches(batches, ["bucket_lo", "batch"], seed=42)


_PENDING_SQL = """
    SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""


def _pending(spark, sf_dir, limits=Limits()):
    docs, done = (
        table(spark, sf_dir, name).withColumn("id", F.col("doc_id").cast("string"))
        for name in ("documents", "labels")
    )
    return resume_pending(docs.select("id", "text"), done, limits=limits)


@query(_PENDING_SQL)
def pending_records(spark, sf_dir):
    return _pending(spark, sf_dir)


@query(_PENDING_SQL)
def pending_by_cascade(spark, sf_dir):
    """With so few bits that many ids hit by chance, and several bitmaps settle them."""
    return _pending(spark, sf_dir, Limits(bits_per_key=2, exact_bytes=256))
