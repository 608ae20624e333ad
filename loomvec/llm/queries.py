"""One thin query per operator: production parameters over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomvec.llm import block_labeller, grid_codes, hard_negatives, hash_tree, language_id, mixing, oracles, token_rollup, toxicity, vector_oracles
from loomvec.llm.bpe_matrix import encode_documents, token_count
from loomvec.llm.dimension_scan import search
from loomvec.llm.fingerprints import fingerprint_edits
from loomvec.llm.jaccard_join import Similarity, similar_components
from loomvec.llm.url_rules import RULES, judge_urls
from loomvec.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_components(table(spark, sf_dir, "documents"), Similarity(words=4, percent=85), count_links=True)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model, keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = encode_documents(table(spark, sf_dir, "documents"), decode=True)
    return made.select(
        "doc_id",
        token_count().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.identify(docs, language_id.fit(docs), keep=["doc_id"])
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected")


TREE = hash_tree.grid(40)


@query(oracles.shards_sql(TREE, hash_tree.grown(TREE)))
def op1_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.assign_shards(table(spark, sf_dir, "documents"), TREE, hash_tree.grown(TREE))


@query(oracles.urls_sql(RULES))
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


@query()
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query()
def op10_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


MIX = mixing.Mix(
    domains={
        "web": [f"src{i}" for i in range(8)],
        "books": [f"src{i}" for i in range(8, 14)],
        "news": [f"src{i}" for i in range(14, 20)],
    },
    domain_weights={"web": 40, "books": 35, "news": 25},
    language_weights={"en": 50, "de": 20, "fr": 20, "es": 10},
)


@query(oracles.mix_sql(MIX))
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix_documents(docs, MIX).select("doc_id", "_mix.*")


@query(
    r"""
    WITH rows AS (
      SELECT doc_id, source, lang, text, regexp_replace(text, 'https?://[^\x20\x09-\x0D]+', '', 'g') AS bare,
             min(doc_id) OVER (PARTITION BY text) AS first FROM documents),
    counts AS (
      SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(bare, '[^\x20\x09-\x0D]+')) AS tokens
      FROM rows WHERE doc_id = first
      UNION ALL
      SELECT source, lang, 'bytes4-1', CAST(ceil(strlen(bare) / 4) AS BIGINT) FROM rows WHERE doc_id = first)
    SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
    FROM counts GROUP BY ALL"""
)
def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "rollup")
    batches = token_rollup.corpus_batches(table(spark, sf_dir, "documents"))
    for name, changes in batches.items():
        token_rollup.commit_batch(root, name, changes)
    # Sent again, a batch must change nothing.
    token_rollup.commit_batch(root, "links", batches["links"])
    return token_rollup.totals(spark, root)


CODES = grid_codes.Settings()


@query(vector_oracles.codes_sql(CODES.scale, CODES.parts, CODES.entries, CODES.rounds))
def op11_grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grid_codes.encode(table(spark, sf_dir, "embeddings"), CODES)
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@query()
def op12_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_labeller.extract_main_text(table(spark, sf_dir, "pages"), block_labeller.fit(), keep=["page_id", "url"])


NEGATIVES = hard_negatives.Settings()


@query(
    vector_oracles.negatives_sql(
        NEGATIVES.scale, NEGATIVES.every, NEGATIVES.positives, NEGATIVES.negatives, NEGATIVES.low, NEGATIVES.high
    )
)
def op13_residue_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every seventh vec_id carries the next label, so that near rows of another label exist.
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), NEGATIVES)
