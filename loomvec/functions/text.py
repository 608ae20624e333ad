"""Text expressions: cleaning, token counts and token truncation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space set of Unicode text, the character cap on cleaned
# text, and the token cap of the embedding services.
WHITE = r"(?U)[\s\x1c-\x1f]+"
NON_WHITE = r"(?U)[^\s\x1c-\x1f]+"
URL = r"(?U)https?://[^\s\x1c-\x1f]+"
MAX_CHARS = 1000
MAX_TOKENS = 2048


def blank_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip_urls(text: Column) -> Column:
    # Most text has no URL, and looking for the letters is cheaper than the pattern.
    return F.when(F.contains(text, F.lit("http")), F.regexp_replace(text, URL, "")).otherwise(text)


def strip_markers(text: Column) -> Column:
    """Drop ``@`` and ``#`` but keep the words they mark."""
    nothing = F.lit("")
    return F.replace(F.replace(text, F.lit("@"), nothing), F.lit("#"), nothing)


def squeeze_white(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITE, " "))


def cap_chars(text: Column, limit: int = MAX_CHARS) -> Column:
    """The first ``limit`` code points."""
    return F.substring(text, 1, limit)


def clean_text(text: Column, limit: int = MAX_CHARS) -> Column:
    """URLs out, markers out, white space squeezed, then capped (in that order)."""
    return cap_chars(squeeze_white(strip_markers(strip_urls(blank_if_null(text)))), limit)


def has_text(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def estimate_tokens(text: Column, cap: int = MAX_TOKENS) -> Column:
    """Number of white-space separated words, at most ``cap``."""
    return F.least(F.lit(cap), F.regexp_count(blank_if_null(text), F.lit(NON_WHITE)))


def truncate_tokens(text: Column, limit: int = MAX_TOKENS) -> Column:
    """The first ``limit`` space-separated tokens, for services that do not truncate."""
    return F.substring_index(text, " ", limit)


def count_tokens_with(
    load: Callable[[], Callable[[list[str]], Sequence[int]]], cap: int = MAX_TOKENS
) -> Callable[[Column], Column]:
    """Exact token counts from any tokenizer, as an Arrow-batched column function.

    ``load`` runs once per Python worker and returns a function from a list of
    texts to their token counts (no special tokens).
    """
    loaded: list = []

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        if not loaded:
            loaded.append(load())
        counts = loaded[0](texts.fillna("").tolist())
        return pd.Series(counts, dtype="int64").clip(upper=cap).astype("int32")

    return count
