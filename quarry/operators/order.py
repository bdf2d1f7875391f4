"""Repeatable shuffle order, global rank, capped samples and train/eval split.

The order of a row is ``md5(seed ":" key)`` then ``key``: it depends only on
the row, not on partitioning or on which other roles ran, and DuckDB can
compute the same order. ``key`` must be unique within a partition group.

Ranks never use a single-partition window over the data. The md5 prefix
gives a bucket (16^k buckets, uniform because md5 is); per-bucket counts are a
map-side-combined aggregate whose size is bounded by 16^k per group, a
running sum over that small table gives each bucket's offset, and
``row_number`` runs only inside a bucket. Operators that need the rank of a
few rows (sample cap, split boundary) rank only the buckets they touch, so
the rest of the data is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..session import materialize

HASH = "_order_hash"
BUCKET = "_order_bucket"
OFFSET = "_bucket_offset"
COUNT = "_bucket_rows"
DEFAULT_BUCKET_HEX = 4  # 65,536 buckets: the offset table stays ≤ 1.5 MB per group
MAX_BUCKET_HEX = 5


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def order_hash(key, seed: int = fixed.SEED) -> Column:
    """md5 of "seed:key1:key2..." (keys cast to string, must be non-null)."""
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") for k in _keys(key)]
    return F.md5(F.concat_ws(":", *parts))


def join_null_safe(x: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on columns of one name, where null meets null, so no group is lost."""
    right = {k: f"_right_{k}" for k in keys}
    same = F.lit(True)
    for k, r in right.items():
        same = same & F.col(k).eqNullSafe(F.col(r))
    return x.join(side.select(*[F.col(c).alias(right.get(c, c)) for c in side.columns]), same).drop(*right.values())


def check_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise where a key stands in two rows, for steps that join their result back by it."""
    twice = df.groupBy(*keys).count().filter("count > 1").take(1)
    if twice:
        raise ValueError(f"{what} needs a unique sample key; repeated: {tuple(twice[0])[:-1]}")


def _with_bucket(df: DataFrame, key, seed: int, bucket_hex: int) -> DataFrame:
    if not 1 <= bucket_hex <= MAX_BUCKET_HEX:
        raise ValueError(f"bucket_hex must be 1 to {MAX_BUCKET_HEX}: the offset table is broadcast")
    return df.withColumn(HASH, order_hash(key, seed)).withColumn(
        BUCKET, F.conv(F.substring(F.col(HASH), 1, bucket_hex), 16, 10).cast("int")
    )


def _bucket_offsets(x: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(parts, bucket, rows, offset): offset = rows in earlier buckets of the group."""
    counts = x.groupBy(*parts, BUCKET).agg(F.count(F.lit(1)).alias(COUNT))
    w = Window.partitionBy(*parts).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(OFFSET, F.coalesce(F.sum(COUNT).over(w), F.lit(0)).cast("long"))


MAX_BROADCAST_ROWS = 2_000_000


def _bounded_offsets(x: DataFrame, parts: Sequence[str], keep: Column | None = None):
    """The offset table and, with grouping columns, its checked row count.

    Without groups the table has at most 16^k rows by construction. With
    groups it is checkpointed and counted, so the broadcast decision rests on
    a measured size.
    """
    offsets = _bucket_offsets(x, parts)
    if keep is not None:
        offsets = offsets.filter(keep)
    if not parts:
        return offsets, None
    offsets = materialize(offsets)
    return offsets, offsets.count()


def _join_offsets(x: DataFrame, offsets: DataFrame, parts: Sequence[str], rows: int | None = None) -> DataFrame:
    # Without grouping columns the table has at most 16^k rows: broadcast it.
    # With groups its size depends on the group count: broadcast it when its
    # row count is known and small, otherwise leave the choice to AQE, which
    # broadcasts only after measuring it.
    small = not parts or (rows is not None and rows <= MAX_BROADCAST_ROWS)
    side = F.broadcast(offsets) if small else offsets
    return join_null_safe(x, side, [*parts, BUCKET])


def _rank_in_bucket(x: DataFrame, parts: Sequence[str], key, out: str) -> DataFrame:
    w = Window.partitionBy(*parts, BUCKET).orderBy(HASH, *_keys(key))
    return x.withColumn(out, (F.col(OFFSET) + F.row_number().over(w)).cast("long"))


def shuffle(df: DataFrame, key, seed: int = fixed.SEED) -> DataFrame:
    """Full repeatable shuffle: a global sort on (md5, key) (range exchange)."""
    return df.withColumn(HASH, order_hash(key, seed)).orderBy(HASH, *_keys(key)).drop(HASH)


def global_rank(
    df: DataFrame,
    key,
    seed: int = fixed.SEED,
    partition_by: Sequence[str] = (),
    out: str = "rank",
    bucket_hex: int = DEFAULT_BUCKET_HEX,
) -> DataFrame:
    """1-based rank of every row in (md5, key) order, per ``partition_by`` group."""
    parts = list(partition_by)
    x = _with_bucket(df, key, seed, bucket_hex)
    offsets, rows = _bounded_offsets(x, parts)
    ranked = _rank_in_bucket(_join_offsets(x, offsets, parts, rows), parts, key, out)
    return ranked.drop(HASH, BUCKET, OFFSET, COUNT)


def sample_n(
    df: DataFrame,
    key,
    n: int | None,
    seed: int = fixed.SEED,
    partition_by: Sequence[str] = (),
    rank_col: str | None = None,
    bucket_hex: int = DEFAULT_BUCKET_HEX,
) -> DataFrame:
    """The first n rows of the shuffle order (per group); None or 0 = no cap.

    Only buckets that start before n are joined and ranked, so the shuffle
    moves about n rows, not the table.
    """
    if n is not None and n < 0:
        raise ValueError("max_samples must be >= 0 (0 or None means no cap)")
    if not n:
        return df if rank_col is None else global_rank(df, key, seed, partition_by, rank_col, bucket_hex)
    parts = list(partition_by)
    x = _with_bucket(df, key, seed, bucket_hex)
    offsets, rows = _bounded_offsets(x, parts, F.col(OFFSET) < F.lit(n))
    out = rank_col or "_rank"
    ranked = _rank_in_bucket(_join_offsets(x, offsets, parts, rows), parts, key, out)
    ranked = ranked.filter(F.col(out) <= F.lit(n)).drop(HASH, BUCKET, OFFSET, COUNT)
    return ranked if rank_col else ranked.drop(out)


def split(
    df: DataFrame,
    key,
    eval_fraction: float = fixed.EVAL_FRACTION,
    seed: int = fixed.SEED,
    partition_by: Sequence[str] = (),
    out: str = "split",
    bucket_hex: int = DEFAULT_BUCKET_HEX,
) -> DataFrame:
    """Exact split: the first ceil(fraction × n) rows of the order are "eval".

    The cut of a group is its last eval row in the order. It lies in one bucket, whose keys alone are ranked;
    a row's label is then a comparison with the cut, so the wide rows are read once and never shuffled.
    Rows with equal keys are on one side of the cut.
    """
    parts, keys = list(partition_by), _keys(key)
    x = _with_bucket(df, keys, seed, bucket_hex)
    narrow = x.select(*parts, *[k for k in keys if k not in parts], HASH, BUCKET)
    offsets = _bucket_offsets(narrow, parts)
    n_eval = F.ceil(F.lit(float(eval_fraction)) * F.sum(COUNT).over(Window.partitionBy(*parts))).cast("long")
    offsets = offsets.withColumn("_n_eval", n_eval)
    edge = materialize(
        offsets.filter((F.col(OFFSET) < F.col("_n_eval")) & (F.col(OFFSET) + F.col(COUNT) >= F.col("_n_eval")))
    )
    groups = edge.count() if parts else 1
    ranked = _rank_in_bucket(_join_offsets(narrow, edge, parts, groups), parts, keys, "_rank")
    place = F.struct(HASH, *keys)
    cuts = ranked.filter(F.col("_rank") == F.col("_n_eval")).select(*parts, place.alias("_cut"))
    if parts:
        cuts = materialize(cuts)
        right = {k: f"_right_{k}" for k in parts}
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(r)) for k, r in right.items()])
        side = cuts.select(*[F.col(k).alias(r) for k, r in right.items()], "_cut")
        labelled = x.join(F.broadcast(side) if groups <= MAX_BROADCAST_ROWS else side, same, "left")
        cut = F.col("_cut")
    else:
        row = cuts.first()  # one row at most
        if row is None:
            return df.withColumn(out, F.lit("train"))
        labelled = x
        cut = F.struct(*[F.lit(v).cast(narrow.schema[c].dataType).alias(c) for c, v in row[0].asDict().items()])
    label = F.when(place <= cut, "eval").otherwise("train")
    return labelled.select(*[F.col(f"`{c}`") for c in df.columns], label.alias(out))


def hash_split(
    df: DataFrame, key, eval_fraction: float = fixed.EVAL_FRACTION, seed: int = fixed.SEED, out: str = "split"
) -> DataFrame:
    """Cheap streaming-safe split: a row is "eval" when its md5 fraction < f.

    Stable when rows are added; the eval size is about, not exactly, f × n.
    """
    frac = F.conv(F.substring(order_hash(key, seed), 1, 8), 16, 10).cast("double") / float(16**8)
    return df.withColumn(out, F.when(frac < F.lit(float(eval_fraction)), "eval").otherwise("train"))


def ordinal_rank(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    out: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """1-based ``row_number`` per group in ``order_by`` order, safe for hot groups.

    A window partitioned by the group would put a group holding a third of
    the rows into one task. Instead the rows are range-partitioned on
    (group, order) — the sampled bounds split a hot group over many tasks —
    sorted within partitions and checkpointed, so partition contents are
    fixed. A (partition, group) count table, small (about partitions +
    groups rows), gives each group's offset in every partition; the rank is
    that offset plus the row's position in its partition. ``order_by`` must
    make the order total within a group.
    """
    parts, keys = list(partition_by), list(order_by)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    fixed_parts = materialize(df.repartitionByRange(n, *parts, *keys).sortWithinPartitions(*parts, *keys))
    x = fixed_parts.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    counts = x.groupBy(*parts, "_pid").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*parts).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))))
    rows = counts.count()
    side = F.broadcast(counts) if rows <= MAX_BROADCAST_ROWS else counts
    ranked = join_null_safe(x, side.select(*parts, "_pid", "_first", "_before"), [*parts, "_pid"])
    ranked = ranked.withColumn(out, (F.col("_before") + F.col("_mid") - F.col("_first") + 1).cast("long"))
    return ranked.drop("_pid", "_mid", "_first", "_before")
