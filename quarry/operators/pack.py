"""Exact sequence packing in parallel.

Rule (sequential form): walk the samples in order with a buffer; before a
sample, if the buffer is non-empty, append one separator (id = EOS, mask 1,
label -100); append the sample; emit every full ``max_len`` block; drop the
tail. With ``pos`` = tokens written so far, the buffer is empty exactly when
``pos % L == 0``, so ``sep = pos % L != 0``, ``start = pos + sep`` and
``pos' = start + len``. Because a sample that starts on a block edge has no
separator, starts are *not* a prefix sum of ``len + 1``.

Parallel form (two passes over lengths only, then one pass over tokens):

1. Rank the samples per group in the repeatable md5 order (``order.global_rank``)
   and cut the ranks into chunks of ``chunk_rows`` samples.
2. Pass A, one pandas call per chunk: with ``P_i`` the chunk-relative prefix
   of ``len + 1``, build ``D[e]`` = separators skipped when the chunk is
   entered at ``pos ≡ e (mod L)``; going backwards, ``D[-P_i] = 1 + D[-P_i - 1]``.
   O(n + L) per chunk; one row (total, D) per chunk.
3. Scan over chunks: ``entry' = entry + total - D[entry % L]``. The chunk
   table is folded on the driver when it has at most ``fanout`` rows;
   otherwise chunks are composed into super-chunks (``D12[e] = D1[e] +
   D2[(e + T1 - D1[e]) % L]``) on the executors first, recursively, so the
   driver never holds more than ``fanout`` rows of L counters.
4. Pass B, one pandas call per chunk: replay from the entry to get each
   sample's start and separator flag.
5. Join the starts back to the token arrays, cut each sample (with its
   separator) into at most two block fragments, group by block (≤ L tokens per
   group, so no group can be skewed), order fragments by offset and keep full
   blocks only.

``pack_bytes`` replaces step 5 where ids are the bytes of a text: the bytes move (one a token, not an array of four-byte
ids), a group takes a run of blocks of the stream, and ids and labels are first made there. No token array is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..session import materialize, ship_package
from .order import check_unique, global_rank, join_null_safe, order_hash

RANK, CHUNK, LEN = "_pk_rank", "_pk_chunk", "_pk_len"
TOTAL, SKIPS, ENTRY = "_pk_total", "_pk_skips", "_pk_entry"
START, SEP = "pack_start", "pack_sep"
MAX_BROADCAST_CHUNKS = 1_000_000
_LIST_ROWS = 1 << 16


def _skip_table(lens: np.ndarray, L: int) -> np.ndarray:
    adv = lens.astype(np.int64) + 1
    prefix = np.concatenate([[0], np.cumsum(adv)])[: len(adv)] % L
    entry_res = (-prefix) % L
    D = np.zeros(L, dtype=np.int64)
    for i in range(len(adv), 0, -_LIST_ROWS):
        for e in entry_res[max(i - _LIST_ROWS, 0) : i][::-1].tolist():
            D[e] = 1 + D[(e - 1) % L]
    return D


def _compose(totals: Sequence[int], skips: Sequence[np.ndarray], L: int) -> tuple[int, np.ndarray]:
    e = np.arange(L, dtype=np.int64)
    acc_t, acc_d = 0, np.zeros(L, dtype=np.int64)
    for t, d in zip(totals, skips):
        acc_d = acc_d + d[(e + acc_t - acc_d) % L]
        acc_t += int(t)
    return acc_t, acc_d


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[n] for n in names]


def _lengths(max_len: int | str, parts: Sequence[str]):
    """(grouping columns, block length of a row, block length as a column).

    A block length per group is a column of the groups' key: it is then at hand wherever a group's rows are."""
    if isinstance(max_len, str):
        return [*parts, *([] if max_len in parts else [max_len])], lambda row: int(row[max_len]), F.col(max_len)
    return list(parts), lambda row: int(max_len), F.lit(int(max_len))


def _summaries(ranked: DataFrame, parts: list[str], length_of) -> DataFrame:
    schema = T.StructType(
        [*_fields(ranked, parts), T.StructField(CHUNK, T.LongType()), T.StructField(TOTAL, T.LongType()),
         T.StructField(SKIPS, T.ArrayType(T.LongType()))]
    )

    def summarize(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(RANK)
        lens, L = pdf[LEN].to_numpy(np.int64), length_of(pdf.iloc[0])
        out = {p: [pdf[p].iloc[0]] for p in parts}
        out[CHUNK] = [int(pdf[CHUNK].iloc[0])]
        out[TOTAL] = [int((lens + 1).sum())]
        out[SKIPS] = [_skip_table(lens, L).tolist()]
        return pd.DataFrame(out)

    return ranked.groupBy(*parts, CHUNK).applyInPandas(summarize, schema)


def _fold_rows(rows, parts: list[str], key_col: str, length_of) -> list[tuple]:
    """Driver fold over a bounded table: (parts..., key_col, entry)."""
    groups: dict[tuple, list] = {}
    for r in rows:
        groups.setdefault(tuple(r[p] for p in parts), []).append(r)
    out = []
    for g, rs in groups.items():
        pos = 0
        for r in sorted(rs, key=lambda r: r[key_col]):
            out.append((*g, r[key_col], pos))
            pos += r[TOTAL] - r[SKIPS][pos % length_of(r)]
    return out


def _entries(
    spark: SparkSession, table: DataFrame, parts: list[str], key_col: str, length_of, fanout: int, n: int | None = None
) -> DataFrame:
    """Entry position of every row of a (parts, key_col, total, skips) table."""
    entry_schema = T.StructType(
        [*_fields(table, parts), T.StructField(key_col, T.LongType()), T.StructField(ENTRY, T.LongType())]
    )
    n = table.count() if n is None else n
    if n > fanout and not table.filter(F.col(key_col) > 0).take(1):
        # One row a group: each enters at 0, however many groups there are.
        return table.select(*parts, F.col(key_col).cast("long").alias(key_col), F.lit(0).cast("long").alias(ENTRY))
    if n <= fanout:
        return spark.createDataFrame(_fold_rows(table.collect(), parts, key_col, length_of), entry_schema)

    sup = f"{key_col}_up"
    grouped = table.withColumn(sup, F.floor(F.col(key_col) / fanout).cast("long"))
    sup_schema = T.StructType(
        [*_fields(table, parts), T.StructField(sup, T.LongType()), T.StructField(TOTAL, T.LongType()),
         T.StructField(SKIPS, T.ArrayType(T.LongType()))]
    )

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key_col)
        total, skips = _compose(pdf[TOTAL].tolist(), [np.asarray(s, dtype=np.int64) for s in pdf[SKIPS]], length_of(pdf.iloc[0]))
        out = {p: [pdf[p].iloc[0]] for p in parts}
        out[sup] = [int(pdf[sup].iloc[0])]
        out[TOTAL] = [total]
        out[SKIPS] = [skips.tolist()]
        return pd.DataFrame(out)

    upper = materialize(grouped.groupBy(*parts, sup).applyInPandas(compose, sup_schema))
    upper_entries = _entries(spark, upper, parts, sup, length_of, fanout).withColumnRenamed(ENTRY, "_up_entry")

    def descend(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key_col)
        pos, L = int(pdf["_up_entry"].iloc[0]), length_of(pdf.iloc[0])
        entries = []
        for t, s in zip(pdf[TOTAL].tolist(), pdf[SKIPS].tolist()):
            entries.append(pos)
            pos += int(t) - int(s[pos % L])
        out = pdf[[*parts, key_col]].copy()
        out[ENTRY] = entries
        return out

    joined = join_null_safe(grouped, upper_entries, [*parts, sup])
    return joined.groupBy(*parts, sup).applyInPandas(descend, entry_schema)


def sample_starts(
    df: DataFrame,
    key,
    max_len: int | str,
    seed: int = fixed.SEED,
    partition_by: Sequence[str] = (),
    ids: str = "input_ids",
    chunk_rows: int = 1 << 20,
    fanout: int = 256,
    length: Column | None = None,
) -> DataFrame:
    """(parts..., key, pack_start, pack_sep, length) for every sample.

    A sample is as long as its ``ids``, or ``length`` where that is known without them.

    ``pack_start`` is the position of the sample's first token in the packed
    stream of its group; ``pack_sep`` = 1 when a separator precedes it. ``max_len``
    is the block length or the column that holds it, one value a group.
    """
    spark = df.sparkSession
    ship_package(spark)
    parts, length_of, _ = _lengths(max_len, partition_by)
    keys = [key] if isinstance(key, str) else list(key)
    # Lengths only (a few bytes per sample), cut from the upstream plan once:
    # ranking reads them twice (bucket counts, then the in-bucket window).
    light = materialize(df.select(*parts, *keys, (F.size(ids) if length is None else length).cast("long").alias(LEN)))
    check_unique(light, [*parts, *keys], "packing")
    ranked = global_rank(light, keys, seed, parts, out=RANK)
    # Both passes must see the same ranks; the ranked lengths are four small
    # columns per sample, so they are checkpointed once instead of re-ranked.
    ranked = materialize(ranked.withColumn(CHUNK, F.floor((F.col(RANK) - 1) / chunk_rows).cast("long")))

    summary = materialize(_summaries(ranked, parts, length_of))
    n_chunks = summary.count()
    entries = _entries(spark, summary, parts, CHUNK, length_of, fanout, n_chunks)

    out_schema = T.StructType(
        [*_fields(ranked, parts), *_fields(ranked, keys), T.StructField(START, T.LongType()),
         T.StructField(SEP, T.IntegerType()), T.StructField("length", T.LongType())]
    )

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(RANK)
        pos, L = int(pdf[ENTRY].iloc[0]), length_of(pdf.iloc[0])
        lens = pdf[LEN].to_numpy(np.int64)
        starts, seps = np.empty(len(lens), np.int64), np.empty(len(lens), np.int32)
        for i in range(0, len(lens), _LIST_ROWS):  # Python's own numbers, for some rows at a time
            for k, n in enumerate(lens[i : i + _LIST_ROWS].tolist(), i):
                sep = 1 if pos % L else 0
                pos += sep
                starts[k] = pos
                seps[k] = sep
                pos += n
        out = pdf[[*parts, *keys]].copy()
        out[START] = starts
        out[SEP] = seps
        out["length"] = lens
        return out

    # The entry table has one row per chunk (samples / chunk_rows); its row
    # count is known, so it is broadcast only under a fixed bound.
    side = F.broadcast(entries) if n_chunks <= MAX_BROADCAST_CHUNKS else entries
    with_entry = join_null_safe(ranked, side, [*parts, CHUNK])
    return with_entry.groupBy(*parts, CHUNK).applyInPandas(place, out_schema)


def pack(
    df: DataFrame,
    key,
    max_len: int | str,
    eos_id: int = fixed.DEFAULT_EOS_ID,
    seed: int = fixed.SEED,
    partition_by: Sequence[str] = (),
    chunk_rows: int = 1 << 20,
    fanout: int = 256,
    materialize_input: bool = False,
) -> DataFrame:
    """Packed blocks: (parts..., block_id, input_ids, attention_mask, labels).

    ``df`` holds ``input_ids``, and ``labels`` where they are not a copy of the
    ids: without them only ids move, and a block's labels are made at its end.
    ``max_len`` is the length of a block or the column that holds it, one value a group (then a column of the result too).
    A sample longer than max_len is cut over as many blocks as it needs. ``key`` must be unique and is checked;
    only the tail of a group is dropped, and a block that is not exactly full
    before it is an error.
    The input is read twice (lengths, then tokens). With an expensive encoder
    upstream, ``materialize_input`` checkpoints the token arrays once so the
    encoder runs once per text; with a cheap one, recomputing is cheaper than
    writing the tokens.
    """
    parts, _, L = _lengths(max_len, partition_by)
    keys = [key] if isinstance(key, str) else list(key)
    held = [c for c in ("labels",) if c in df.columns]
    if materialize_input:
        df = materialize(df.select(*parts, *keys, "input_ids", *held))
    starts = sample_starts(df, keys, max_len, seed, parts, "input_ids", chunk_rows, fanout)
    starts = starts.select(*parts, *keys, START, SEP)
    tokens = join_null_safe(df.select(*parts, *keys, "input_ids", *held), starts, [*parts, *keys])
    sep = F.col(SEP) == 1
    carried = {"_ids": ("input_ids", int(eos_id)), "_labels": ("labels", fixed.IGNORE_LABEL)}
    carried = {out: x for out, x in carried.items() if x[0] in df.columns}
    first = F.col(START) - F.col(SEP)
    frag = tokens.select(
        *parts,
        sep.alias("_sep"),
        *[F.when(sep, F.concat(F.array(F.lit(v)), F.col(c))).otherwise(F.col(c)).alias(o) for o, (c, v) in carried.items()],
        F.floor(first / L).cast("long").alias("_block"),
        F.pmod(first, L).cast("int").alias("_off"),
    ).withColumn("_cuts", F.ceil((F.col("_off") + F.size("_ids")) / L).cast("int"))
    frag = frag.withColumn("_cut", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1))).filter(F.size("_ids") > 0)
    first_id = F.when(F.col("_cut") == 0, F.lit(1)).otherwise(F.col("_cut") * L - F.col("_off") + 1)
    n_ids = F.when(F.col("_cut") == 0, L - F.col("_off")).otherwise(L)
    exploded = frag.select(
        *parts,
        (F.col("_block") + F.col("_cut")).alias("block_id"),
        F.when(F.col("_cut") == 0, F.col("_off")).otherwise(0).alias("offset"),
        (F.col("_sep") & (F.col("_cut") == 0)).alias("sep"),
        *[F.slice(c, first_id, n_ids).alias(c) for c in carried],
    )
    blocks = exploded.groupBy(*parts, "block_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "sep", *carried))).alias("_frags")
    )

    def labels_of(f):
        ignored = F.concat(F.array(F.lit(fixed.IGNORE_LABEL)), F.slice(f["_ids"], F.lit(2), L))
        return f["_labels"] if held else F.when(f["sep"], ignored).otherwise(f["_ids"])

    blocks = blocks.select(
        *parts,
        "block_id",
        F.flatten(F.transform("_frags", lambda f: f["_ids"])).alias("input_ids"),
        F.flatten(F.transform("_frags", labels_of)).alias("labels"),
    )
    n = F.size("input_ids")
    long = F.raise_error(F.concat(F.lit("packed block over its length: "), n.cast("string"))).cast("boolean")
    blocks = blocks.filter(F.when(n > L, long).otherwise(n == L))
    return blocks.select(
        *parts, "block_id", "input_ids", F.array_repeat(F.lit(1), L).alias("attention_mask"), "labels"
    )


def _fill(table: pa.Table, base: int, size: int, eos_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, labels) of the packed stream from ``base`` on, up to where it ends or ``size`` tokens are full.

    ``table`` holds the samples that meet this stretch, with their bytes; those at its ends are cut."""
    data = table.column("_bytes").combine_chunks()
    data = data.cast(pa.large_binary())
    off = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)
    start = table.column(START).to_numpy() - base
    n = np.diff(off)
    at = np.repeat(start - (off[:-1] - off[0]), n) + np.arange(off[-1] - off[0])
    here = (at >= 0) & (at < size)
    before = start[table.column(SEP).to_numpy() == 1] - 1
    before = before[(before >= 0) & (before < size)]
    ids, labels = np.zeros(size, np.int32), np.full(size, fixed.IGNORE_LABEL, np.int32)
    ids[at[here]] = raw[off[0] : off[-1]][here]
    labels[at[here]] = ids[at[here]]
    ids[before] = eos_id
    held = np.bincount(np.concatenate([at[here], before]), minlength=size)
    end = int(np.count_nonzero(held))
    if (held[:end] != 1).any():
        raise ValueError("packed blocks with a gap or an overlap: the input has changed between its two reads")
    return ids[:end], labels[:end]


def pack_bytes(
    df: DataFrame,
    key,
    max_len: int | str,
    text: str = "text",
    eos_id: int = fixed.DEFAULT_EOS_ID,
    seed: int = fixed.SEED,
    partition_by: Sequence[str] = (),
    chunk_rows: int = 1 << 20,
    fanout: int = 256,
    group_tokens: int = 1 << 20,
) -> DataFrame:
    """``pack`` of the UTF-8 bytes of a text column, each cut to ``max_len``; the same blocks, without token arrays on the way.

    Lengths come from the strings in the JVM. Texts, as bytes, meet their starts in one join and go by runs of about
    ``group_tokens`` tokens of the packed stream to the tasks that cut the blocks; a text at the edge of two runs goes to both. A run
    holds at most that many tokens (one block at least) and the two texts at its edges, however texts are spread. A null text is empty."""
    df, starts = _placed_bytes(df, key, max_len, text, seed, partition_by, chunk_rows, fanout)
    return _cut_runs(df, starts, max_len, eos_id, partition_by, group_tokens)


def pack_bytes_slices(
    df: DataFrame,
    key,
    max_len: int | str,
    slices: int,
    text: str = "text",
    eos_id: int = fixed.DEFAULT_EOS_ID,
    seed: int = fixed.SEED,
    partition_by: Sequence[str] = (),
    chunk_rows: int = 1 << 20,
    fanout: int = 256,
    group_tokens: int = 1 << 20,
    slice_tokens: int = 1 << 26,
) -> list[DataFrame]:
    """``pack_bytes`` as at most ``slices`` DataFrames, each the blocks of one stretch of the packed stream.

    A caller that uses them one after the other has the shuffles of one stretch on disk, not those of all texts. The texts
    are read once a slice, and only those that meet the stretch are shuffled: the stream is in the order of ``order_hash``, so
    they lie between two hashes. (With groups of very unlike size these bounds are wide; the rows are the same.) Streams of
    less than ``slice_tokens`` a slice are cut into fewer."""
    keys = [key] if isinstance(key, str) else list(key)
    df, starts = _placed_bytes(df, keys, max_len, text, seed, partition_by, chunk_rows, fanout)
    starts = materialize(starts)
    first_run, last_run = _runs(max_len, partition_by, group_tokens)
    n_runs, n_tokens = starts.agg(F.max(last_run) + 1, F.max(F.col(START) + F.col("length"))).first()
    n = max(1, min(slices, (n_tokens or 0) // slice_tokens, n_runs or 0))
    cuts = [i * (n_runs or 0) // n for i in range(n)] + [n_runs or 0]
    if n == 1:
        return [_cut_runs(df, starts, max_len, eos_id, partition_by, group_tokens)]
    meets = [(first_run < b) & (last_run >= a) for a, b in zip(cuts, cuts[1:])]
    hashes = order_hash(keys, seed)
    ends = starts.agg(*[f(F.when(m, hashes)) for m in meets for f in (F.min, F.max)]).first()
    return [
        _cut_runs(df.filter(hashes.between(*ends[2 * i : 2 * i + 2])), starts.filter(m), max_len, eos_id, partition_by, group_tokens, cuts[i : i + 2])
        for i, m in enumerate(meets)
    ]


def _placed_bytes(df: DataFrame, key, max_len, text: str, seed: int, partition_by, chunk_rows: int, fanout: int) -> tuple[DataFrame, DataFrame]:
    """(samples with their bytes, their starts)."""
    parts, _, L = _lengths(max_len, partition_by)
    keys = [key] if isinstance(key, str) else list(key)
    data = F.substring(F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")), F.lit(1), L.cast("int"))
    df = df.select(*parts, *keys, data.alias("_bytes"))
    return df, sample_starts(df, keys, max_len, seed, parts, chunk_rows=chunk_rows, fanout=fanout, length=F.octet_length("_bytes"))


def _runs(max_len: int | str, partition_by: Sequence[str], group_tokens: int) -> tuple[Column, Column]:
    """First and last run that a sample meets."""
    L = _lengths(max_len, partition_by)[2]
    run = F.greatest(F.floor(F.lit(group_tokens) / L), F.lit(1)) * L
    first, end = F.col(START) - F.col(SEP), F.col(START) + F.col("length")
    return F.floor(first / run).cast("long"), F.floor((end - 1) / run).cast("long")


def _cut_runs(
    df: DataFrame, starts: DataFrame, max_len, eos_id: int, partition_by, group_tokens: int, only: Sequence[int] | None = None
) -> DataFrame:
    """The blocks of all runs, or of those from the first to before the second of ``only``."""
    parts, length_of, L = _lengths(max_len, partition_by)
    keys = [c for c in df.columns if c not in (*parts, "_bytes")]
    x = join_null_safe(df, starts, [*parts, *keys])
    first_run, last_run = _runs(max_len, partition_by, group_tokens)
    x = x.filter(F.col(START) - F.col(SEP) < F.col(START) + F.col("length"))
    x = x.select(*parts, START, SEP, "_bytes", F.explode(F.sequence(first_run, last_run)).alias("_run"))
    if only is not None:
        x = x.filter((F.col("_run") >= only[0]) & (F.col("_run") < only[1]))

    fields = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("input_ids", "labels")]
    schema = T.StructType([*_fields(x, parts), T.StructField("block_id", T.LongType()), *fields])

    def cut(group: tuple, table: pa.Table) -> pa.Table:
        group = dict(zip([*parts, "_run"], group))
        size = length_of({c: v.as_py() for c, v in group.items()})
        blocks = max(group_tokens // size, 1)
        first_block = group["_run"].as_py() * blocks
        ids, labels = _fill(table, first_block * size, blocks * size, eos_id)
        n = len(ids) // size  # the tail of the last run is no block
        at = pa.array(np.arange(n + 1) * size, pa.int32())
        out = {p: pa.repeat(group[p], n) for p in parts}
        out["block_id"] = pa.array(first_block + np.arange(n), pa.int64())
        out["input_ids"] = pa.ListArray.from_arrays(at, pa.array(ids[: n * size]))
        out["labels"] = pa.ListArray.from_arrays(at, pa.array(labels[: n * size]))
        return pa.table(out)

    ship_package(df.sparkSession)
    blocks = x.groupBy(*parts, "_run").applyInArrow(cut, schema)
    return blocks.select(*parts, "block_id", "input_ids", F.array_repeat(F.lit(1), L.cast("int")).alias("attention_mask"), "labels")


def pack_stats(starts: DataFrame, max_len: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """samples in, blocks out, trailing tokens dropped (per group)."""
    end = F.max(F.col(START) + F.col("length"))
    agg = starts.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("samples"), F.coalesce(end, F.lit(0)).alias("_end"))
    return agg.select(
        *partition_by,
        "samples",
        F.floor(F.col("_end") / max_len).cast("long").alias("blocks"),
        F.pmod(F.col("_end"), F.lit(int(max_len))).cast("long").alias("dropped_tokens"),
    )
