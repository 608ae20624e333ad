from __future__ import annotations

import sys

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from loomvec.functions import lengths, text
from loomvec.operators.embed import prepare_texts


def apply(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    out = rows.select("i", function(F.col("text")).alias("o")).orderBy("i").collect()
    return [row.o for row in out]


@pytest.mark.parametrize(
    ("raw", "cleaned"),
    [
        ("a b https://x.y/z　tail @u #h", "a b tail u h"),
        ("\u001c\u001d x \u0085", "x"),
        ("http://only", ""),
        ("  @ # ", ""),
        ("", ""),
        (None, ""),
        ("see http and https: no link", "see http and https: no link"),
        ("HTTP://kept http://gone,too", "HTTP://kept"),
        ("ht@tp://x y", "http://x y"),
    ],
)
def test_clean_text(spark, raw, cleaned):
    assert apply(spark, text.clean_text, [raw]) == [cleaned]


def test_cap_counts_code_points_and_comes_last(spark):
    emoji, spaced = "😀" * 1001, "a" * 999 + " b"
    assert apply(spark, text.clean_text, [emoji, spaced]) == ["😀" * 1000, "a" * 999 + " "]


def test_every_white_space_character_is_squeezed(spark):
    white = [chr(c) for c in range(sys.maxunicode) if chr(c).isspace()]
    assert len(white) == 29
    values = [f"{w}a{w}{w}b{w}" for w in white] + ["a​b", "a᠎b"]
    assert apply(spark, text.squeeze_white, values) == ["a b"] * 29 + ["a​b", "a᠎b"]
    assert apply(spark, text.estimate_tokens, values[:29]) == [2] * 29


def test_prepare_texts_drops_what_is_empty(spark):
    rows = spark.createDataFrame(
        [("1", "hi"), ("2", None), ("3", ""), ("4", " \t"), ("5", "http://x")], "id string, text string"
    )
    assert [row.id for row in prepare_texts(rows).orderBy("id").collect()] == ["1"]
    kept = prepare_texts(rows, clean=False).orderBy("id").collect()
    assert [(row.id, row.text) for row in kept] == [("1", "hi"), ("4", " \t"), ("5", "http://x")]


def test_token_estimate_is_capped(spark):
    assert apply(spark, text.estimate_tokens, ["w " * 3000, "", None]) == [2048, 0, 0]
    assert apply(spark, lambda c: text.truncate_tokens(c, 2), ["a b c", "a", ""]) == ["a b", "a", ""]


def test_any_tokenizer_can_count(spark):
    def load():
        words = Tokenizer(models.WordLevel({"[UNK]": 0, "a": 1}, unk_token="[UNK]"))
        words.pre_tokenizer = pre_tokenizers.Whitespace()
        return lambda texts: [len(e.ids) for e in words.encode_batch(texts, add_special_tokens=False)]

    assert apply(spark, text.count_tokens_with(load, cap=4), ["a, b!", "a b c d e f", None]) == [4, 4, 0]


def test_length_buckets_cover_their_bounds(spark):
    values = sorted({n for low, high in lengths.LENGTH_BUCKETS for n in (low, high)} | {2049, 4000})
    rows = spark.createDataFrame([(n,) for n in values], "n int")
    found = rows.select("n", lengths.bucket_low(F.col("n")), lengths.bucket_high(F.col("n"))).collect()
    for n, low, high in found:
        assert low <= n <= high
        assert (low, high) in [*lengths.LENGTH_BUCKETS, lengths.OVERFLOW_BUCKET]
