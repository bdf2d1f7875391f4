"""Array column functions for unit-test lists and section rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from .text import _col, clean


def coerce_tests(tests, dtype: T.DataType) -> Column:
    """Coerce test elements to strings by the column's schema.

    struct element → its ``code`` field (null code → ""); string element →
    itself; a null element prints as ``None`` (``str(None)``). A string column
    holds a JSON array of strings or of objects with a ``code``.
    """
    c = _col(tests)
    if isinstance(dtype, T.StringType):
        parsed = F.from_json(c, "array<string>")
        return F.transform(
            parsed,
            lambda x: F.when(x.isNull(), F.lit("None"))
            .when(x.startswith("{"), F.coalesce(F.get_json_object(x, "$.code"), F.lit("")))
            .otherwise(x),
        )
    elem = dtype.elementType if isinstance(dtype, T.ArrayType) else T.StringType()
    if isinstance(elem, T.StructType):
        return F.transform(
            c, lambda x: F.when(x.isNull(), F.lit("None")).otherwise(F.coalesce(x["code"], F.lit("")))
        )
    return F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("None")))


def cap_tests(tests: Column, cap: int = fixed.MAX_UNIT_TESTS) -> Column:
    """First ``cap`` elements, *then* cleaned with blanks dropped (an array)."""
    return F.filter(F.transform(F.slice(tests, 1, cap), clean), lambda x: x != F.lit(""))


def join_blank_line(parts: Column) -> Column:
    return F.array_join(parts, "\n\n")


def join_tests(tests: Column) -> Column:
    """All elements joined by one newline, no cleaning (null element → "")."""
    return F.array_join(tests, "\n", "")


def sections(*parts) -> Column:
    """Concatenate literal strings and columns (columns must be non-null)."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
