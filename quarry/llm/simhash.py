"""SimHash near-duplicates by a generalised pigeonhole.

A text's fingerprint has one bit per majority vote of its shingles' 64-bit hashes. Two texts are linked
when their fingerprints differ in at most ``max_bits`` bits; a class is a connected component.

Search (exact: no link is lost):

1. Distinct fingerprints only; copies of any number are one fingerprint.
2. The 64 bits are grouped into ``max_bits + 1`` partitions of equal width so that correlated bits stand
   together (bit co-occurrence counted over all fingerprints).
3. A threshold per partition, -1 (not searched) and up, with sum max_bits - partitions + 1: two linked
   fingerprints are within the threshold in some partition, whatever the allocation. Dynamic programming
   picks the allocation with the fewest estimated candidates, from the counts of all partition values.
4. Each fingerprint goes to the bucket of its value in each searched partition, and probes the buckets of
   all values within the threshold.
5. A bucket over ``bucket_rows`` is dealt again, on the bits not yet used, by the plain pigeonhole
   (max_bits + 1 parts, one of them equal), level after level, so no task gets an unbounded bucket.
6. Within a bucket every pair is verified by its bit distance; a bucket returns a spanning forest of its
   links, never all pairs. The forests' components are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import connected_components, free_name, id_and_text, local_roots, ready

BITS = 64
MAX_BROADCAST_KEYS = 200_000


def fingerprint(text: bytes, words_per_shingle: int = 3, block: int = 1 << 16) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text (0 without words)."""
    w = text.lower().split()  # on bytes both touch ASCII only
    k = words_per_shingle
    if not w:
        return 0
    ones, n = np.zeros(BITS, np.int64), max(1, len(w) - k + 1)
    for i in range(0, n, block):
        part = w[i : min(i + block, n) + k - 1]
        shingles = zip(*(part[j:] for j in range(k))) if len(w) >= k else [w]
        digests = b"".join([xxhash.xxh64_digest(b" ".join(s), 42) for s in shingles])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row per row of df; null text counts as empty."""
    ready(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), words_per_shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


# ---- the generalised pigeonhole ---------------------------------------------------------------


def bit_correlations(values: DataFrame) -> np.ndarray:
    """64 x 64 absolute correlations of the bits over all fingerprints; only 4,096 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), np.int64)
        for b in batches:
            x = _bits(np.asarray(b.column(0)).astype(np.int64)).astype(np.float32)
            both += (x.T @ x).round().astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS, dtype=np.int32)), pa.array(both.ravel())], ["cell", "n"])

    rows = values.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    both, n = np.zeros(BITS * BITS), max(1, values.count())
    for r in rows:
        both[r["cell"]] = r["n"]
    both = both.reshape(BITS, BITS) / n
    p = both.diagonal()
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs(both - np.outer(p, p)) / np.outer(sd, sd)


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Equal groups of bits, each grown from the most correlated free pair by the bit closest to it."""
    free, width, out = list(range(BITS)), BITS // parts, []
    c = corr.copy()
    np.fill_diagonal(c, -1)
    for k in range(parts):
        size = width if k < parts - 1 else len(free)
        sub = c[np.ix_(free, free)]
        i, j = np.unravel_index(int(sub.argmax()), sub.shape)
        group = sorted({free[i], free[j]})
        while len(group) < size:
            rest = [b for b in free if b not in group]
            group.append(max(rest, key=lambda b: (c[b, group].mean(), -b)))
        out.append(sorted(group[:size]))
        free = [b for b in free if b not in out[-1]]
    return out


def _bits(fp: np.ndarray) -> np.ndarray:
    """n x 64 bits; column b is bit b, counted from the least significant."""
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def part_value(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.int64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.int64(b)) & np.int64(1)) << np.int64(k)
    return out


def masks(width: int, most: int) -> np.ndarray:
    """All XOR masks of at most `most` bits, by weight."""
    out, last = [0], [0]
    for _ in range(most):
        last = sorted({m | (1 << b) for m in last for b in range(width) if not m >> b & 1})
        out += last
    return np.array(out, np.int64)


def estimated_candidates(values: DataFrame, groups: list[list[int]], most: int) -> np.ndarray:
    """cost[part, e]: candidate pairs plus probes if partition `part` is searched with threshold e, from the counts of
    all its values (at most 2^width of them, so each group below is bounded)."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.asarray(b.column(0)).astype(np.int64)
            v = np.concatenate([part_value(fp, g) for g in groups])
            p = np.repeat(np.arange(len(groups), dtype=np.int32), len(fp))
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(v)], ["part", "value"])

    def cost(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        h = np.zeros(1 << len(groups[part]))
        h[pdf["value"].to_numpy()] = pdf["n"].to_numpy()
        at = np.flatnonzero(h)
        rows, near, done = [], np.zeros(len(at)), 0
        for e in range(most + 1):
            m = masks(len(groups[part]), e)
            for x in m[done:]:
                near += h[at ^ x]
            done = len(m)
            rows.append((part, e, float((h[at] * near).sum() + h.sum() * len(m))))
        return pd.DataFrame(rows, columns=["part", "e", "cost"])

    n = values.mapInArrow(explode, "part int, value long").groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    out = np.zeros((len(groups), most + 1))
    for r in n.groupBy("part").applyInPandas(cost, "part int, e int, cost double").collect():
        out[r["part"], r["e"]] = r["cost"]
    return out


def allocate(cost: np.ndarray, max_bits: int) -> list[int]:
    """Thresholds (-1 and up) with sum max_bits - parts + 1 and the least total cost, by dynamic programming."""
    parts, top = cost.shape[0], cost.shape[1] - 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for p in range(parts):
        new: dict[int, tuple[float, list[int]]] = {}
        for total, (c, t) in best.items():
            for e in range(-1, top + 1):
                x = (c + (cost[p, e] if e >= 0 else 0.0), [*t, e])
                if total + e not in new or x < new[total + e]:
                    new[total + e] = x
        best = new
    return best[max_bits - parts + 1][1]


def _bucket_rows(values: DataFrame, groups: list[list[int]], thresholds: list[int]) -> DataFrame:
    """(key, fp, used): every fingerprint in the buckets it belongs to or probes; used: bits that the key fixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.asarray(b.column(0)).astype(np.int64)
            for p, (g, t) in enumerate(zip(groups, thresholds)):
                if t < 0:
                    continue
                v, used = part_value(fp, g), np.int64(np.bitwise_or.reduce(np.left_shift(np.uint64(1), np.array(g, np.uint64))).astype(np.int64))
                for m in masks(len(g), t):
                    key = (np.int64(p) << np.int64(40)) | (v ^ m)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp), pa.array(np.full(len(fp), used))], ["key", "fp", "used"])

    return values.mapInArrow(run, "key long, fp long, used long")


def _finer(rows: DataFrame, max_bits: int) -> DataFrame:
    """Deal the rows of large buckets again by their unused bits: max_bits + 1 parts, of which a linked pair has one equal."""
    parts = max_bits + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, fp, used = (np.asarray(c).astype(np.int64) for c in b.columns)
            for u in np.unique(used):
                at = used == u
                left = [k for k in range(BITS) if not int(u) >> k & 1]
                for p in range(parts):
                    g = left[p::parts]
                    mask = np.int64(np.bitwise_or.reduce(np.left_shift(np.uint64(1), np.array(g, np.uint64))).astype(np.int64))
                    out = [key[at], np.full(at.sum(), p), part_value(fp[at], g), fp[at], np.full(at.sum(), u | mask)]
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], ["k", "p", "v", "fp", "used"])

    x = rows.select("key", "fp", "used").mapInArrow(run, "k long, p long, v long, fp long, used long")
    return x.select(F.xxhash64("k", "p", "v", "used").alias("key"), "fp", "used")


def _links_in(max_bits: int):
    """Streams sorted (key, fp) rows, finishes each bucket when the next key begins, and returns its spanning forest."""

    def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        a, b, live, d = [], [], np.arange(len(key)), 0
        while len(live):
            d += 1
            live = live[live + d < len(key)]
            live = live[key[live] == key[live + d]]
            near = live[np.bitwise_count(fp[live] ^ fp[live + d]) <= max_bits]
            a.append(near)
            b.append(near + d)
        root = local_roots(len(key), np.concatenate(a or [np.zeros(0, int)]), np.concatenate(b or [np.zeros(0, int)]))
        at = np.flatnonzero(root != np.arange(len(key)))
        return pa.RecordBatch.from_arrays([pa.array(fp[at].view(np.int64)), pa.array(fp[root[at]].view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, np.asarray(batch.column(0)).astype(np.int64)])
            fp = np.concatenate([fp, np.asarray(batch.column(1)).astype(np.int64).view(np.uint64)])
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if cut:
                yield links(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield links(key, fp)

    return run


def fingerprint_links(values: DataFrame, max_bits: int = 3, bucket_rows: int = 1024) -> DataFrame:
    """(a, b): links that connect every two fingerprints of `values` (distinct, column fp) within max_bits."""
    if max_bits < 2:
        raise ValueError("max_bits must be 2 or more: fewer leave groups of bits too wide to be counted")
    ready(values)
    groups = group_bits(bit_correlations(values), max_bits + 1)
    most = min(2, max_bits)
    thresholds = allocate(estimated_candidates(values, groups, most), max_bits)
    rows, found = _bucket_rows(values, groups, thresholds), None
    while rows is not None:
        rows = materialize(rows)
        large = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket_rows).select("key"))
        n_large = large.count()
        side = F.broadcast(large) if n_large <= MAX_BROADCAST_KEYS else large
        free = BITS - F.bit_count("used")
        again, here = None, rows
        if n_large:
            marked = rows.join(side.withColumn("large", F.lit(True)), "key", "left")
            deal = F.col("large") & (free > int(np.log2(bucket_rows)))
            again, here = marked.filter(deal), marked.filter(~F.coalesce(deal, F.lit(False)))
            again = again if again.take(1) else None
        ordered = here.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
        new = materialize(ordered.mapInArrow(_links_in(max_bits), "a long, b long"))
        found = new if found is None else found.union(new)
        rows = None if again is None else _finer(again, max_bits)
    return found


def _roots(df: DataFrame, id_col: str, text_col: str, words_per_shingle: int, max_bits: int, bucket_rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row; (fp, low, root) of every fingerprint: its smallest id and its class."""
    docs = materialize(fingerprints(df, id_col, text_col, words_per_shingle))
    values = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("low")))
    parts = connected_components(fingerprint_links(values.select("fp"), max_bits, bucket_rows))
    return docs, values.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))


def simhash_classes(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = 3,
    max_bits: int = 3,
    bucket_rows: int = 1024,
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of df.

    fingerprint: 16 hex digits. component_id: the smallest doc_id of the rows whose fingerprints are reachable
    over links of at most max_bits bits. Null and empty texts have fingerprint zero and are linked like others.
    Rows with a null doc_id keep a row and take part in the links; a class of such rows alone has a null
    component_id. Repeated rows get a row each. An empty table gives an empty result; other columns are ignored.
    """
    docs, rooted = _roots(df, id_col, text_col, words_per_shingle, max_bits, bucket_rows)
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of_fp = rooted.join(lows, "root").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return docs.join(of_fp, "fp").select("doc_id", hexed, "component_id")


def keep_one_of_each_class(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = 3,
    max_bits: int = 3,
    bucket_rows: int = 1024,
) -> DataFrame:
    """The rows of df, one of each near-duplicate class: that with the smallest id (null ids last).

    Where the smallest id stands in several rows, their fingerprints are compared again and one row with the
    smallest stays. All columns stay as they were, whatever their names. Null and empty texts have fingerprint zero. An
    empty table stays empty.
    """
    docs, rooted = _roots(df, id_col, text_col, words_per_shingle, max_bits, bucket_rows)
    rooted = materialize(rooted)
    # Per fingerprint the smallest id is known already, so a class is the minimum over its fingerprints.
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("low").isNull().alias("none"), "low", "fp")).alias("x"))
    first = first.select(F.col("x.low").alias("keep_id"), F.col("x.fp").alias("keep_fp"))
    many = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1 or doc_id is null")
    marked = first.join(many, F.col("keep_id").eqNullSafe(F.col("doc_id")), "left")
    marked = materialize(marked.select("keep_id", "keep_fp", F.col("rows").isNotNull().alias("several")))
    ident = F.col(f"`{id_col}`").cast("long")
    single = free_name(df, "keep_id")
    kept = df.join(marked.filter("not several").select(F.col("keep_id").alias(single)), ident == F.col(single), "left_semi")
    several = marked.filter("several")
    if not several.take(1):
        return kept

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint((t or "").encode(), words_per_shingle) for t in texts], dtype="int64")

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), ident.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.join(several.select("keep_id").distinct(), F.col("id").eqNullSafe(F.col("keep_id")), "left_semi")
    rows = rows.withColumn("fp", of("text")).join(several, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("fp") == F.col("keep_fp")), "left_semi")
    return kept.unionByName(rows.dropDuplicates(["id", "fp"]).select("row.*"))
