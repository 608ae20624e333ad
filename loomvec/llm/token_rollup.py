"""Token counts kept up to date by signed deltas.

Totals by source, language and tokenizer version are sums of deltas. A batch of changes (inserts,
deletes, revised counts) becomes signed rows, is summed, and is written once as the batch's
delta. A batch counts once its commit file has its name; the file is written under another name first and
renamed without overwriting, so it is there whole or not at all. It names the written delta: a batch that is sent again, or was
written twice by a repeated job, changes nothing. Deltas add up in any order.

``fold`` adds up what is committed into a base, published in the same way with the list of its batches. Totals are the
newest base and the deltas committed since.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomvec.session import materialise

KEYS = ("source", "lang", "tokenizer")
_TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"
_SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long, batch string, attempt string"


def _files(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _name(batch: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_OID, batch).hex


def _publish(spark: SparkSession, path: str, line: str) -> bool:
    """Make a file of one line, whole and once: False if there is one of that name."""
    files, where = _files(spark, path)
    if files.exists(where):
        if files.getFileStatus(where).getLen():
            return False
        files.delete(where, False)  # created by a writer that died before it wrote
    _, draft = _files(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = files.create(draft, False)
    out.write(bytearray((line + "\n").encode()))
    out.close()
    jvm = spark.sparkContext._jvm
    strict = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(where), strict)
    except Exception:
        files.delete(draft, False)
        if files.exists(where):
            return False  # another writer was first
        raise
    return True


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the published, non-empty files of a folder, from its listing."""
    files, where = _files(spark, folder)
    if not files.exists(where):
        return []
    found = ((f.getPath().getName(), f.getLen()) for f in files.listStatus(where))
    return sorted(name for name, length in found if length and name.endswith(".json"))


def _base(spark: SparkSession, root: str) -> tuple[int, DataFrame, DataFrame]:
    """Version, totals and batch names of the newest base; version 0 is empty."""
    names = _names(spark, f"{root}/bases")
    if not names:
        return 0, spark.createDataFrame([], _TOTALS), spark.createDataFrame([], "name string")
    folder = json.loads(spark.read.text(f"{root}/bases/{names[-1]}").first()[0])["folder"]
    where = f"{root}/folded/{folder}"
    return int(names[-1][:-5]), spark.read.schema(_TOTALS).parquet(f"{where}/totals"), spark.read.schema("name string").parquet(f"{where}/batches")


def _since(spark: SparkSession, root: str, folded: DataFrame) -> tuple[list[str], DataFrame]:
    """Names and deltas of the batches committed since a base; only their files are opened."""
    listed = _names(spark, f"{root}/commits")
    if listed:
        known = spark.createDataFrame([(name[:-5],) for name in listed], "name string")
        listed = sorted(r.name for r in known.join(folded, "name", "left_anti").collect())
    if not listed:
        return [], spark.createDataFrame([], _SCHEMA)
    lines = spark.read.text([f"{root}/commits/{name}.json" for name in listed])
    commits = lines.select(F.from_json("value", "batch string, attempt string").alias("c")).select("c.*").where("attempt IS NOT NULL")
    attempts = [r.attempt for r in commits.collect()]
    if not attempts:
        return [], spark.createDataFrame([], _SCHEMA)
    return listed, spark.read.schema(_SCHEMA).parquet(*[f"{root}/deltas/{a}" for a in attempts])


def signed(changes: DataFrame) -> DataFrame:
    """Signed rows ``(source, lang, tokenizer, docs, tokens)`` of ``changes``.

    ``changes (change, source, lang, tokenizer, tokens, old_tokens, ...)``: ``insert`` adds a document and its
    tokens, ``delete`` takes both away, ``revise`` replaces ``old_tokens`` by ``tokens``. Null counts are 0; null
    keys are keys of their own; a change of another name or null fails the batch.
    """
    new, old = (F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("tokens", "old_tokens"))
    change = F.col("change")
    wrong = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(change, F.lit("null"))))
    docs = F.when(change == "insert", 1).when(change == "delete", -1).when(change == "revise", 0).otherwise(wrong.cast("int"))
    tokens = F.when(change == "insert", new).when(change == "delete", -new).otherwise(new - old)
    return changes.select(*[F.col(k).cast("string").alias(k) for k in KEYS], docs.cast("long").alias("docs"), tokens.alias("tokens"))


def _write(rows: DataFrame, root: str, batch: str) -> bool:
    spark = rows.sparkSession
    attempt = uuid.uuid4().hex
    rows.withColumn("batch", F.lit(batch)).withColumn("attempt", F.lit(attempt)).write.parquet(f"{root}/deltas/{attempt}")
    return _publish(spark, f"{root}/commits/{_name(batch)}.json", json.dumps({"batch": batch, "attempt": attempt}))


def commit_batch(root: str, batch: str, changes: DataFrame) -> bool:
    """Add a batch's changes to the totals under ``root``, once; False if the batch was there already."""
    spark = changes.sparkSession
    files, where = _files(spark, f"{root}/commits/{_name(batch)}.json")
    if files.exists(where) and files.getFileStatus(where).getLen():
        return False
    # Summed before the shuffle, so a hot source is one row per task.
    delta = signed(changes).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return _write(delta, root, batch)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def totals(spark: SparkSession, root: str) -> DataFrame:
    """``(source, lang, tokenizer, docs, tokens)`` over all committed batches; keys without documents and tokens are left out."""
    _, base, folded = _base(spark, root)
    _, deltas = _since(spark, root, folded)
    return _summed(base.unionByName(deltas.select(base.columns))).where("docs <> 0 or tokens <> 0")


def fold(spark: SparkSession, root: str) -> int:
    """Add the batches committed since the last base to a new one; how many there were.

    The new base counts once it is published; a fold that dies before leaves nothing but unused files, and of two folds
    at a time one is published. Deltas in a published base are not read any more.
    """
    version, base, folded = _base(spark, root)
    names, deltas = _since(spark, root, folded)
    if not names:
        return 0
    folder = uuid.uuid4().hex
    _summed(base.unionByName(deltas.select(base.columns))).write.parquet(f"{root}/folded/{folder}/totals")
    folded.unionByName(spark.createDataFrame([(n,) for n in names], "name string")).write.parquet(f"{root}/folded/{folder}/batches")
    return len(names) if _publish(spark, f"{root}/bases/{version + 1:012d}.json", json.dumps({"folder": folder})) else 0


WORD = r"[^\x20\x09-\x0D]+"
LINK = r"https?://[^\x20\x09-\x0D]+"


def counters(text: Column) -> dict[str, Column]:
    """Token counts of a text by tokenizer version: words between white space, and bytes in groups of four."""
    made = {"words-1": F.regexp_count(text, F.lit(WORD)), "bytes4-1": F.ceil(F.octet_length(text) / 4)}
    return {name: F.coalesce(count.cast("long"), F.lit(0).cast("long")) for name, count in made.items()}


def corpus_batches(docs: DataFrame) -> dict[str, DataFrame]:
    """Changes of a corpus by batch: all documents, new counts without links, and copies taken out.

    ``load`` inserts every row of ``docs (doc_id, text, lang, source, ...)``. ``links`` revises the counts of texts that
    hold links. ``copies`` deletes rows whose text a row with a smaller doc_id has (a null doc_id is the
    smallest, and rows that repeat a doc_id with its text all stay). Null texts are empty. Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), text.alias("text"),
    )
    # Links are taken out once per text.
    rows = rows.select("*", F.explode(F.array(F.regexp_replace("text", LINK, ""))).alias("bare"))
    before, after = counters(F.col("text")), counters(F.col("bare"))
    pairs = F.array(*[F.struct(F.lit(n).alias("tokenizer"), before[n].alias("old"), after[n].alias("new")) for n in before])
    rows = materialise(rows.select("doc_id", "source", "lang", F.md5(F.encode("text", "UTF-8")).alias("h"), pairs.alias("counts")), "counts")
    flat = rows.select("doc_id", "source", "lang", "h", F.inline("counts"))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("first"))
    copies = rows.join(first, "h").where("doc_id > first").select("source", "lang", F.inline("counts"))
    none = F.lit(None).cast("long")
    return {
        "load": flat.select(F.lit("insert").alias("change"), *KEYS, F.col("old").alias("tokens"), none.alias("old_tokens")),
        "links": flat.where("old <> new").select(F.lit("revise").alias("change"), *KEYS, F.col("new").alias("tokens"), F.col("old").alias("old_tokens")),
        "copies": copies.select(F.lit("delete").alias("change"), *KEYS, F.col("new").alias("tokens"), none.alias("old_tokens")),
    }
