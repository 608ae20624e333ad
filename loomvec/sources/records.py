"""Line-delimited JSON records: one parse per line, bad lines set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomvec.functions.once import with_once
from loomvec.functions.text import has_text

# Why a line is not a usable record, in the order the checks run.
MALFORMED = "malformed"
NO_ID = "no _id"
NULL_ID = "null _id"
NO_TEXT = "no text"
TEXT_NOT_STRING = "text is not a string"
REASONS = [MALFORMED, NO_ID, NULL_ID, NO_TEXT, TEXT_NOT_STRING]

_NUMBERS_TO_REJECT = ["NaN", "Infinity", "-Infinity"]


def _parsed(lines: DataFrame) -> DataFrame:
    # The line is read as the only element of an array, so that anything before or
    # after the object is an error.
    objects = F.from_json(
        F.concat(F.lit("["), F.col("value"), F.lit("]")),
        "array<struct<_id: variant, text: variant>>",
        {"allowSingleQuotes": "false"},
    )
    whole = F.rtrim(F.col("value"), F.lit(" \t\r\n")).endswith("}")
    return (
        with_once(lines, "_o", objects)
        .withColumn("_r", F.when(whole & (F.size("_o") == 1), F.get("_o", F.lit(0))))
        .select("value", F.col("_r").isNotNull().alias("_ok"), "_r._id", "_r.text")
    )


def float_text(number: Column) -> Column:
    """A double written the way Python does: ``10000000.0``, ``1e+16``, ``1.5e-07``."""
    size, text = F.abs(number), number.cast("string")
    digits = number.try_cast("decimal(38,20)").cast("string")
    fixed = F.regexp_replace(digits, r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(power < 0, "e-0").otherwise("e+0")
    exponent = F.when(F.abs(power) > 9, F.substring(sign, 1, 2)).otherwise(sign)
    return F.when((size == 0) | ((size >= 1e-4) & (size < 1e16)), fixed).otherwise(
        F.concat(mantissa, exponent, F.abs(power).cast("string"))
    )


def normalize_id(id_: Column) -> Column:
    """A variant ``_id`` as a string: its ``$oid`` if it has one, else its value."""
    plain, type_ = id_.cast("string"), F.schema_of_variant(id_)
    number = plain.try_cast("double")
    # Decimals are how variants hold number texts with a point, and integers beyond 64 bits.
    is_float = (type_ == "DOUBLE") | (
        type_.startswith("DECIMAL") & (plain.contains(".") | (F.abs(number) < 2.0**63))
    )
    return F.coalesce(
        F.try_variant_get(id_, "$['$oid']", "string"),
        F.when(type_ == "BOOLEAN", F.initcap(plain)).when(is_float, float_text(number)).otherwise(plain),
    )


def normalize_id_json(id_json: Column) -> Column:
    """The same for an id held as JSON text, or as a plain string."""
    as_variant = F.try_parse_json(id_json)
    return F.coalesce(normalize_id(as_variant), id_json)


def judge_lines(lines: DataFrame, require_text: bool = True) -> DataFrame:
    """Every line with ``id``, ``text`` and ``reason`` (null when it is a record).

    ``require_text=False`` lets records without a ``text`` key pass; their text is null.
    """
    id_, text = F.col("_id"), F.col("text")
    id_type, text_type = F.schema_of_variant(id_), F.schema_of_variant(text)
    no_number = (id_type == "DOUBLE") & id_.cast("string").isin(_NUMBERS_TO_REJECT)
    reason = (
        F.when(~F.col("_ok") | no_number, MALFORMED)
        .when(id_.isNull(), NO_ID)
        .when(id_type == "VOID", NULL_ID)
        .when(text.isNull() & F.lit(require_text), NO_TEXT)
        .when(~text_type.isin("STRING", "VOID"), TEXT_NOT_STRING)
    )
    return _parsed(lines).select(
        "value",
        normalize_id(id_).alias("id"),
        F.when(text_type == "STRING", text.cast("string")).alias("text"),
        reason.alias("reason"),
    )


def records_of(judged: DataFrame) -> DataFrame:
    """``(id, text)`` of the good lines."""
    return judged.where(F.col("reason").isNull()).select("id", "text")


def quarantine_of(judged: DataFrame) -> DataFrame:
    """``(value, reason)`` of the lines set aside."""
    return judged.where(F.col("reason").isNotNull()).select("value", "reason")


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.text(list(paths))


def read_records(spark: SparkSession, *paths: str, require_text: bool = True) -> DataFrame:
    """``(id, text)`` records of JSONL files."""
    return records_of(judge_lines(read_lines(spark, *paths), require_text))


def with_text(records: DataFrame) -> DataFrame:
    return records.where(has_text(F.col("text")))
