"""String column functions (all JVM-side Catalyst expressions).

``clean`` is Python's ``(x or "").strip()``: null becomes "" and *Unicode*
whitespace is removed from both ends. Spark's ``trim`` only removes spaces,
so the whitespace set is passed to ``btrim`` explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts (29 code points), built from
# Python's own rule so the set is exact by definition.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()`` on a non-null string (null stays null)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def clean(c) -> Column:
    """``(x or "").strip()``: null → "", Unicode whitespace trimmed."""
    return strip_ws(F.coalesce(_col(c), F.lit("")))


def is_blank(c) -> Column:
    return clean(c) == F.lit("")


def first_line(c) -> Column:
    """``text.split("\\n")[0]`` (null stays null)."""
    return F.substring_index(_col(c), "\n", 1)


def char_len(c) -> Column:
    """Length in code points, like Python ``len``."""
    return F.char_length(_col(c))


def lower_window(c, n: int) -> Column:
    """``(x or "")[:n].lower()`` — the first n code points, lowercased."""
    return F.lower(F.substring(F.coalesce(_col(c), F.lit("")), 1, n))


def contains_any(text: Column, keywords) -> Column:
    """OR of plain substring tests; false for an empty keyword list."""
    cond = F.lit(False)
    for kw in keywords:
        cond = cond | F.contains(text, F.lit(kw))
    return cond


def sql_whitespace_literal() -> str:
    """The whitespace set as a DuckDB/ANSI expression (for oracle SQL)."""
    return "||".join(f"chr({ord(c)})" for c in WHITESPACE)
