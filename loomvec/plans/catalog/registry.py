"""The registry, and the pieces of SQL and rendering the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomvec.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its oracle if it has one."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as ``(id, text)`` records."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")


def rendered(vector: Column) -> Column:
    """A vector as text in whole millionths, so that engines can be compared exactly."""
    whole = F.transform(vector, lambda x: F.round(x.cast("double") * 1e6).cast("bigint").cast("string"))
    return F.array_join(whole, ",")


def rendered_sql(vector: str) -> str:
    return f"array_to_string(list_transform({vector}, lambda x: CAST(round(CAST(x AS DOUBLE) * 1e6) AS BIGINT)), ',')"


def scaled_sql(vector: str) -> str:
    """A vector brought to unit length, as 32-bit floats."""
    return (
        f"list_transform({vector}, lambda x: CAST(CAST(x AS DOUBLE) / "
        f"(sqrt(list_sum(list_transform({vector}, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))) + 1e-12) AS FLOAT))"
    )


# Fixed value: the Unicode white space set as a character class of DuckDB's patterns.
_WHITE_SQL = (
    r"\t\n\v\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def strip_urls_sql(text: str) -> str:
    return rf"regexp_replace({text}, 'https?://[^{_WHITE_SQL}]+', '', 'g')"


def strip_markers_sql(text: str) -> str:
    return f"replace(replace({text}, '@', ''), '#', '')"


def squeeze_white_sql(text: str) -> str:
    return rf"trim(regexp_replace({text}, '[{_WHITE_SQL}]+', ' ', 'g'))"


def clean_text_sql(text: str) -> str:
    bare = squeeze_white_sql(strip_markers_sql(strip_urls_sql(f"coalesce({text}, '')")))
    return f"substring({bare}, 1, 1000)"


def estimate_tokens_sql(text: str) -> str:
    words = rf"len(regexp_extract_all(coalesce({text}, ''), '[^{_WHITE_SQL}]+'))"
    return f"CAST(least(2048, {words}) AS INTEGER)"


def hashed_sql(source: str, dims: int) -> str:
    """Hash embeddings of a relation ``(id, text)`` as ``(id, embedding)``, in SQL."""
    return f"""
    WITH texts AS ({source}),
    tokens AS (SELECT id, unnest(string_split(text, ' ')) AS token FROM texts),
    hashed AS (
      SELECT id,
             CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % {dims} AS slot,
             1 - 2 * (CAST('0x' || substr(md5(token), 9, 1) AS BIGINT) % 2) AS sign
      FROM tokens WHERE token <> ''),
    sums AS (SELECT id, slot, CAST(sum(sign) AS DOUBLE) AS s FROM hashed GROUP BY id, slot),
    norms AS (SELECT id, sqrt(sum(s * s)) + 1e-12 AS n FROM sums GROUP BY id),
    grid AS (SELECT id, n, unnest(range({dims})) AS slot FROM norms)
    SELECT id, list(CAST(coalesce(s, 0) / n AS FLOAT) ORDER BY slot) AS embedding
    FROM grid LEFT JOIN sums USING (id, slot) GROUP BY id"""


CLEAN_DOCUMENTS_SQL = f"""
    SELECT id, text FROM (
      SELECT CAST(doc_id AS VARCHAR) AS id, {clean_text_sql("text")} AS text
      FROM documents WHERE text <> '') WHERE text <> ''"""
