"""Batch collation: pad each batch of samples to its longest member.

Batches are consecutive ranks of the repeatable order (``rank div B``), so a
batch has at most B rows: the per-batch maximum is a window over a bounded
group. Ranks and maxima are found on (key, length) alone; the token arrays move
once, in the join that brings each sample its batch. Pads use ``pad_id``
(default: the EOS id), mask 0 and label -100.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..session import materialize
from .order import check_unique, global_rank, join_null_safe

LEN = "_n_ids"


def collate(
    df: DataFrame,
    key,
    batch_size: int,
    pad_id: int = fixed.DEFAULT_EOS_ID,
    seed: int = fixed.SEED,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Adds rank, batch, batch_len, padded input_ids / attention_mask / labels (per group).

    ``key`` must be unique within its group and is checked. Null groups are groups like others.
    """
    parts, keys = list(partition_by), [key] if isinstance(key, str) else list(key)
    light = materialize(df.select(*parts, *keys, F.size("input_ids").alias(LEN)))
    check_unique(light, [*parts, *keys], "collation")
    ranked = global_rank(light, keys, seed, parts, out="rank")
    ranked = ranked.withColumn("batch", F.floor((F.col("rank") - 1) / batch_size).cast("long"))
    w = Window.partitionBy(*parts, "batch")
    places = ranked.withColumn("batch_len", F.max(LEN).over(w)).drop(LEN)
    x = join_null_safe(df, places, [*parts, *keys])
    pad = F.col("batch_len") - F.size("input_ids")
    return x.select(
        *[c for c in x.columns if c not in ("input_ids", "attention_mask", "labels")],
        F.concat("input_ids", F.array_repeat(F.lit(int(pad_id)), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("input_ids")), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
        F.concat("labels", F.array_repeat(F.lit(fixed.IGNORE_LABEL), pad)).alias("labels"),
    )
