"""Prompt rendering: instruction template and the plain chat rendering."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import _col


def render_instruction(instruction, inp, output) -> Column:
    """"### Instruction:\\n{i}\\n\\n### Input:\\n{in}\\n\\n### Response:\\n{o}".

    Null fields render as "" (the builders never emit nulls).
    """
    h1, h2, h3 = fixed.INSTRUCTION_HEADINGS
    v = [F.coalesce(_col(x).cast("string"), F.lit("")) for x in (instruction, inp, output)]
    return F.concat(F.lit(h1), v[0], F.lit(h2), v[1], F.lit(h3), v[2])


def render_chat(messages) -> Column:
    """"<|role|>\\ncontent" per message joined by "\\n"; role defaults to user."""
    return F.array_join(
        F.transform(
            _col(messages),
            lambda m: F.concat(
                F.lit(fixed.CHAT_ROLE_OPEN),
                F.coalesce(m["role"], F.lit(fixed.CHAT_DEFAULT_ROLE)),
                F.lit(fixed.CHAT_ROLE_CLOSE),
                F.coalesce(m["content"], F.lit("")),
            ),
        ),
        fixed.CHAT_JOIN,
    )


def chat_template_udf(template_factory: Callable[[], Callable[[list[dict]], str]]):
    """A user chat template (messages → text) as an Arrow-batched UDF.

    ``template_factory`` is called once per batch call on the worker (build
    the template object there, not per row); each row's messages arrive as a
    list of {"role", "content"} dicts.
    """

    @F.pandas_udf("string")
    def render(messages: pd.Series) -> pd.Series:
        template = template_factory()
        out = []
        for ms in messages:
            rows = [] if ms is None else [{"role": m["role"], "content": m["content"]} for m in ms]
            out.append(template(rows))
        return pd.Series(out)

    return render
