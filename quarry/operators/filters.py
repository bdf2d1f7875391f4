"""Row filters (DataFrame → DataFrame).

Each is a plain ``filter`` so Catalyst can combine them with the projection
into one whole-stage-codegen span; none shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import chat
from ..functions.text import char_len, clean


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Every column non-empty: strings after cleaning, arrays by size."""
    cond = F.lit(True)
    for c in cols:
        dtype = df.schema[c].dataType.typeName()
        if dtype == "array":
            cond = cond & (F.coalesce(F.size(F.col(c)), F.lit(0)) > 0)
        else:
            cond = cond & (clean(c) != F.lit(""))
    return df.filter(cond)


def min_chars(df: DataFrame, col: str, n: int = fixed.MIN_OUTPUT_CHARS) -> DataFrame:
    """Keep rows whose cleaned value has at least n code points."""
    return df.filter(char_len(clean(col)) >= n)


def max_chars(df: DataFrame, col: str, n: int = fixed.MAX_CODE_CHARS) -> DataFrame:
    """Keep rows whose cleaned value has at most n code points (n itself kept)."""
    return df.filter(char_len(clean(col)) <= n)


def lang_in(df: DataFrame, col: str, langs: Iterable[str] = fixed.SECURITY_LANGS) -> DataFrame:
    return df.filter(F.lower(clean(col)).isin(list(langs)))


def min_turns(df: DataFrame, messages: str = "messages", n: int = fixed.MIN_TURNS) -> DataFrame:
    return df.filter(F.coalesce(F.size(F.col(messages)), F.lit(0)) >= n)


def any_keyword(
    df: DataFrame,
    messages: str = "messages",
    keywords: Iterable[str] = fixed.REVIEW_KEYWORDS,
    per_message: int = fixed.KEYWORD_WINDOW,
) -> DataFrame:
    return df.filter(chat.any_keyword(messages, tuple(keywords), per_message))


def all_groups_keyword(df: DataFrame, messages: str = "messages", groups=None) -> DataFrame:
    groups = groups or (fixed.OPTIMIZATION_KEYWORDS, fixed.OPTIMIZATION_LANG_KEYWORDS)
    return df.filter(chat.all_groups_first(messages, groups))


def non_blank(df: DataFrame, col: str = "value") -> DataFrame:
    """Skip blank lines."""
    return df.filter(clean(col) != F.lit(""))
