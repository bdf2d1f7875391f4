"""Encoding text to token ids (truncate to max_len, no padding).

Output columns: ``input_ids``, ``attention_mask`` (ones) and ``labels`` (a
copy of the ids), like a batched tokenizer call with truncation.

Encoders:

* ``byte_encode`` — UTF-8 bytes as ids (DuckDB can compute the same ids);
  Arrow-batched by default, or pure Catalyst expressions.
* ``encode_with`` — any user encoder ``list[str] -> list[list[int]]`` run over
  Arrow batches with ``mapInArrow``; the encoder is built once per task from
  a picklable factory, never per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.text import _col

IDS = T.ArrayType(T.IntegerType())
#: Ids that are gathered at once by the byte encoder.
RUN_IDS = 1 << 18


def utf8_bytes(text) -> Column:
    """UTF-8 bytes of the whole string as array<int> (0..255), JVM only."""
    hexed = F.hex(F.encode(F.coalesce(_col(text), F.lit("")), "UTF-8"))
    pairs = F.regexp_extract_all(hexed, F.lit("([0-9A-F]{2})"), 1)
    return F.transform(pairs, lambda h: F.conv(h, 16, 10).cast("int"))


def _arrow_bytes(max_len: int):
    """Arrow-batched encoder of texts, or of their UTF-8 bytes, cut to ``max_len`` ids."""

    @F.arrow_udf(IDS)
    def encode(texts: pa.Array) -> pa.Array:
        # The ids are the bytes of the Arrow buffer, gathered up to max_len each; no Python list is made.
        data = pc.fill_null(texts.cast(pa.binary()), b"")
        if not len(data):
            return pa.array([], pa.list_(pa.int32()))
        kind = np.int64 if pa.types.is_large_binary(data.type) else np.int32
        off = np.frombuffer(data.buffers()[1], kind)[data.offset : data.offset + len(data) + 1].astype(np.int64)
        raw = data.buffers()[2]
        n = np.minimum(np.diff(off), max_len)
        first = np.concatenate([[0], np.cumsum(n)])
        ids = np.empty(first[-1], np.int32)
        raw = np.frombuffer(raw if raw is not None else b"", np.uint8)
        # Runs of rows of about RUN_IDS ids: a position is eight bytes, so those of a whole batch would be many times its text.
        edges = [0, *np.unique(np.searchsorted(first, np.arange(RUN_IDS, first[-1], RUN_IDS))).tolist(), len(n)]
        for i, j in zip(edges, edges[1:]):
            at = np.repeat(off[i:j] - first[i:j], n[i:j])
            at += np.arange(first[i], first[j])
            ids[first[i] : first[j]] = raw[at]
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids))

    return encode


def with_encoding(df: DataFrame, ids: Column | str, max_len: int) -> DataFrame:
    """Truncate ids to max_len; add attention_mask (ones) and labels (copy)."""
    x = df.withColumn("input_ids", F.slice(_col(ids), 1, max_len))
    return x.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))).withColumn(
        "labels", F.col("input_ids")
    )


def byte_encode(
    df: DataFrame, text: str = "text", max_len: int = 4096, drop_text: bool = True, engine: str = "arrow"
) -> DataFrame:
    """UTF-8 byte ids of the whole text, truncated to max_len.

    ``engine="arrow"`` (default) encodes in Arrow batches with Python's C
    encoder — Spark has no binary → array<byte> built-in, and the JVM form
    (``engine="jvm"``: hex, regex split, base conversion) is about ten times
    slower on long texts. Both encode the whole text and give the same ids.
    """
    if engine == "arrow":
        from ..session import ship_package

        ship_package(df.sparkSession)
        # Cut in the JVM, so that a batch of long texts is no longer than its ids.
        cut = F.substring(F.col(text).cast("binary"), F.lit(1), F.lit(int(max_len)))
        ids = _arrow_bytes(int(max_len))(cut)
    elif engine == "jvm":
        ids = utf8_bytes(text)
    else:
        raise ValueError(f"unknown engine {engine!r}")
    out = with_encoding(df, ids, max_len)
    return out.drop(text) if drop_text else out


def encode_with(
    df: DataFrame,
    encoder_factory: Callable[[], Callable[[list[str]], Iterable[Iterable[int]]]],
    text: str = "text",
    max_len: int = 4096,
) -> DataFrame:
    """Run a user encoder over Arrow batches; it is built once per task. The text column is dropped."""
    from ..session import ship_package

    ship_package(df.sparkSession)
    keep = [f for f in df.schema.fields if f.name != text]
    out_schema = T.StructType([*keep, T.StructField("_ids", IDS)])
    names = [f.name for f in keep]
    text_pos = df.columns.index(text)

    def run(batches):
        encode = encoder_factory()
        for batch in batches:
            texts = [t if t is not None else "" for t in batch.column(text_pos).to_pylist()]
            ids = [list(map(int, x)) for x in encode(texts)]
            cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(ids, type=pa.list_(pa.int32()))], names=[*names, "_ids"])

    encoded = df.mapInArrow(run, out_schema)
    return with_encoding(encoded, "_ids", max_len).drop("_ids")


def eos_id(value: int | None) -> int:
    """Separator id: the tokenizer's EOS, or 0 when it has none."""
    return fixed.DEFAULT_EOS_ID if not value else int(value)
