"""Docstring removal as array expressions (no UDF, no backtracking regex).

Rule: split the code on "\\n". The first line that, stripped and with leading
``rRuUbB`` letters removed, starts with a triple quote opens the docstring.
If the same triple quote appears again later on that line, only that line is
dropped. Otherwise every line up to and including the first later line that
contains the quote is dropped; an unclosed docstring drops the rest. Later
docstrings stay. The opener may be on any line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _col, strip_ws

_PREFIX_LETTERS = "rRuUbB"  # string prefix letters removed before the quote test
_QUOTES = ('"""', "'''")


def _check(line: Column) -> Column:
    """The stripped line without leading string-prefix letters."""
    return F.ltrim(strip_ws(line), F.lit(_PREFIX_LETTERS))


def _is_opener(check: Column) -> Column:
    return F.startswith(check, F.lit(_QUOTES[0])) | F.startswith(check, F.lit(_QUOTES[1]))


def _contains(q: str):
    return lambda l: F.contains(l, F.lit(q))


def _last_dropped(lines: Column, opener: Column) -> Column:
    """1-based index of the last line the docstring covers (opener ≥ 1)."""
    n = F.size(lines)
    open_check = _check(F.get(lines, opener - 1))
    quote = F.substring(open_check, 1, 3)
    same_line = F.contains(F.substring(open_check, 4, 1 << 30), quote)
    later = F.slice(lines, opener + 1, F.greatest(n - opener, F.lit(0)))
    closers = [F.array_position(F.transform(later, _contains(q)), True).cast("int") for q in _QUOTES]
    closer_rel = F.when(quote == F.lit(_QUOTES[0]), closers[0]).otherwise(closers[1])
    return F.when(same_line, opener).when(closer_rel > 0, opener + closer_rel).otherwise(n)


def _drop_lines(lines: Column, first: Column, last: Column) -> Column:
    n = F.size(lines)
    kept = F.concat(
        F.slice(lines, 1, F.greatest(first - 1, F.lit(0))),
        F.slice(lines, last + 1, F.greatest(n - last, F.lit(0))),
    )
    return F.array_join(kept, "\n")


def _opener(lines: Column) -> Column:
    return F.array_position(
        F.transform(lines, lambda l: _is_opener(_check(l))), True
    ).cast("int")


def strip_docstring(code) -> Column:
    """Single-expression form (each intermediate is recomputed where used;
    prefer ``with_docstring_stripped`` on large data)."""
    lines = F.split(_col(code), "\n", -1)
    opener = _opener(lines)
    return F.when(opener == 0, _col(code)).otherwise(_drop_lines(lines, opener, _last_dropped(lines, opener)))


def with_docstring_stripped(df: DataFrame, code: str, out: str) -> DataFrame:
    """Add ``out`` = code without its first docstring.

    The line array and the opener position are projected as columns first,
    so the per-line scan runs once per row. No lambda refers to a column
    computed outside it (outer references are re-evaluated per element).
    """
    lines, op, last = "_ds_lines", "_ds_opener", "_ds_last"
    x = df.withColumn(lines, F.split(F.col(code), "\n", -1))
    x = x.withColumn(op, _opener(F.col(lines)))
    x = x.withColumn(last, F.when(F.col(op) > 0, _last_dropped(F.col(lines), F.col(op))))
    x = x.withColumn(
        out, F.when(F.col(op) == 0, F.col(code)).otherwise(_drop_lines(F.col(lines), F.col(op), F.col(last)))
    )
    return x.drop(lines, op, last)
