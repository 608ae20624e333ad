"""Reading JSONL records that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomvec.plans.catalog.registry import query, table
from loomvec.session import scratch_path
from loomvec.sources import records as source


def _written(lines, name):
    path = scratch_path(lines.sparkSession, name)
    lines.write.text(path)
    return path


@query("SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents WHERE text IS NOT NULL")
def read_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    line = F.to_json(F.struct(F.col("doc_id").alias("_id"), "text", "lang", "n_chars"))
    return source.read_records(spark, _written(docs.select(line), "documents-jsonl"))


@query("""
    SELECT conv_id || '-' || turn AS id, text FROM conversations
    UNION ALL SELECT conv_id || '-' || turn, NULL FROM conversations""")
def read_records_any(spark, sf_dir):
    """Every turn with its text, and once more without a text key."""
    turns = table(spark, sf_dir, "conversations")
    # to_json leaves out null fields.
    text = F.explode(F.array("text", F.lit(None).cast("string")))
    turns = turns.select(F.concat_ws("-", "conv_id", "turn").alias("_id"), text.alias("text"))
    line = F.to_json(F.struct("_id", "text"))
    path = _written(turns.select(line), "turns-jsonl")
    return source.read_records(spark, path, require_text=False)


@query("""
    SELECT CASE lang WHEN 'en' THEN CAST(doc_id AS VARCHAR)
                     WHEN 'fr' THEN 'oid-' || doc_id
                     WHEN 'de' THEN '{"k":' || doc_id || '}'
                     ELSE CASE WHEN n_chars > 1000 THEN 'True' ELSE 'False' END END AS id,
           n_chars FROM documents""")
def normalize_id(spark, sf_dir):
    doc, lang = F.col("doc_id"), F.col("lang")
    id_json = (
        F.when(lang == "en", doc.cast("string"))
        .when(lang == "fr", F.to_json(F.struct(F.concat(F.lit("oid-"), doc).alias("$oid"))))
        .when(lang == "de", F.to_json(F.struct(doc.alias("k"))))
        .otherwise(F.when(F.col("n_chars") > 1000, "true").otherwise("false"))
    )
    docs = table(spark, sf_dir, "documents")
    return docs.select(source.normalize_id_json(id_json).alias("id"), "n_chars")


# Sources that write bad lines, and the verdict that has to follow.
_BAD_SOURCES = {
    "src1": source.MALFORMED,  # cut off
    "src2": source.MALFORMED,  # junk after the object
    "src3": source.MALFORMED,  # an array
    "src4": source.NO_ID,
    "src5": source.NULL_ID,
    "src6": source.NO_TEXT,
    "src7": source.TEXT_NOT_STRING,
    "src8": source.MALFORMED,  # two objects
}


def _lines(spark, sf_dir):
    """The documents as JSONL, some sources' lines spoilt in their own way."""
    docs = table(spark, sf_dir, "documents")
    id_, text, name = F.col("doc_id").alias("_id"), F.col("text"), F.col("source")
    good = F.to_json(F.struct(id_, text))
    null_id = F.concat(F.lit('{"_id":null,'), F.substring(F.to_json(F.struct(text)), 2, 1 << 30))
    line = (
        F.when(name == "src1", F.substring_index(good, "}", 1))
        .when(name == "src2", F.concat(good, F.lit(" junk")))
        .when(name == "src3", F.concat(F.lit("["), good, F.lit("]")))
        .when(name == "src4", F.to_json(F.struct(text)))
        .when(name == "src5", null_id)
        .when(name == "src6", F.to_json(F.struct(id_)))
        .when(name == "src7", F.to_json(F.struct(id_, F.col("n_chars").alias("text"))))
        .when(name == "src8", F.concat(good, F.lit(" "), good))
        .otherwise(good)
    )
    return source.read_lines(spark, _written(docs.select(line.alias("value")), "mixed-jsonl"))


_CASES = " ".join(f"WHEN '{name}' THEN '{reason}'" for name, reason in _BAD_SOURCES.items())
_BAD_SQL = ", ".join(f"'{name}'" for name in _BAD_SOURCES)


@query(f"""
    SELECT CASE source {_CASES} ELSE 'ok' END AS reason, count(*) AS lines
    FROM documents GROUP BY ALL""")
def judge_lines(spark, sf_dir):
    judged = source.judge_lines(_lines(spark, sf_dir))
    return judged.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("lines"))


@query(f"SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents WHERE source NOT IN ({_BAD_SQL})")
def records_among_bad_lines(spark, sf_dir):
    return source.records_of(source.judge_lines(_lines(spark, sf_dir)))


# The text as a JSON string without blanks at the end of the line, as the writer gives it.
_TEXT_JSON = "CAST(to_json(text) AS VARCHAR)"
_GOOD_JSON = f"""'{{"_id":' || doc_id || ',"text":' || {_TEXT_JSON} || '}}'"""


@query(f"""
    SELECT CASE source {_CASES} END AS reason,
           CASE source WHEN 'src1' THEN regexp_extract({_GOOD_JSON}, '^[^}}]*')
                       WHEN 'src2' THEN {_GOOD_JSON} || ' junk'
                       WHEN 'src3' THEN '[' || {_GOOD_JSON} || ']'
                       WHEN 'src4' THEN '{{"text":' || {_TEXT_JSON} || '}}'
                       WHEN 'src5' THEN '{{"_id":null,"text":' || {_TEXT_JSON} || '}}'
                       WHEN 'src6' THEN '{{"_id":' || doc_id || '}}'
                       WHEN 'src7' THEN '{{"_id":' || doc_id || ',"text":' || n_chars || '}}'
                       WHEN 'src8' THEN {_GOOD_JSON} || ' ' || {_GOOD_JSON} END AS value
    FROM documents WHERE source IN ({_BAD_SQL})""")
def quarantine_lines(spark, sf_dir):
    return source.quarantine_of(source.judge_lines(_lines(spark, sf_dir))).select("reason", "value")
