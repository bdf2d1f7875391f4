"""Conversation (array<struct<role,content>>) column functions.

All are higher-order array expressions evaluated in the JVM; intermediate
arrays that are used twice should be projected as columns first, because
subexpressions inside lambdas are not shared.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import _col, clean, contains_any, lower_window


def normalize_role(role: Column) -> Column:
    """user/assistant/system kept; human → user; anything else → assistant.

    A struct field is always there; a null one is no known role: assistant.
    """
    return (
        F.when(role.isin("user", "assistant", "system"), role)
        .when(role == "human", F.lit("user"))
        .otherwise(F.lit("assistant"))
    )


def clean_messages(messages) -> Column:
    """Normalise roles, clean contents, drop messages whose content is empty."""
    normalized = F.transform(
        _col(messages),
        lambda m: F.struct(
            normalize_role(m["role"]).alias("role"), clean(m["content"]).alias("content")
        ),
    )
    return F.filter(normalized, lambda m: m["content"] != F.lit(""))


def joined_windows(messages, n: int = fixed.KEYWORD_WINDOW) -> Column:
    """First n characters of each message, lowercased, joined by one space.

    Null content counts as "" so the joining space is kept (``concat_ws``
    would skip a null element and lose a separator).
    """
    return F.array_join(F.transform(_col(messages), lambda m: lower_window(m["content"], n)), " ")


def any_keyword(messages, keywords=fixed.REVIEW_KEYWORDS, n: int = fixed.KEYWORD_WINDOW) -> Column:
    return contains_any(joined_windows(messages, n), keywords)


def first_content(messages) -> Column:
    """Content of the first message (null when the array is empty)."""
    return F.get(_col(messages), 0)["content"]


def all_groups_first(messages, groups) -> Column:
    """The first message (full length, lowercased) has a word of every group."""
    text = F.lower(F.coalesce(first_content(messages), F.lit("")))
    cond = F.lit(True)
    for group in groups:
        cond = cond & contains_any(text, group)
    return cond


def later_assistant_parts(messages) -> Column:
    """Messages 2..n whose role is exactly "assistant", cleaned; empties kept."""
    m = _col(messages)
    tail = F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0)))
    return F.transform(F.filter(tail, lambda x: x["role"] == F.lit("assistant")), lambda x: clean(x["content"]))


def assistant_reply(parts: Column) -> Column:
    return F.array_join(parts, "\n\n")
