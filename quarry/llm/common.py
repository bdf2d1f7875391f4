"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, shared_dir, ship_package

#: ASCII white space [\x20\x09-\x0D], as a Java/RE2 character class and as a strip set.
WS_CLASS = r"[\x20\x09-\x0D]"
WS_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ready(df: DataFrame) -> None:
    """Make Python workers able to import this package and name the shared folder."""
    shared_dir(df.sparkSession)
    ship_package(df.sparkSession)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only; ``lower`` is the fast way where the value is plain ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or the next name like it that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id long, text binary): null texts are empty, all other columns are left behind."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice's text is about max_bytes (one longer row stands alone)."""
    if not batch.num_rows:
        return
    off = offsets_of(batch.column(column))
    i = 0
    while i < batch.num_rows:
        j = max(int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1, i + 1)
        yield batch.slice(i, min(j, batch.num_rows) - i)
        i = j


def offsets_of(arr: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type) else np.int32
    return np.frombuffer(arr.buffers()[1], kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)


def bytes_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary array without nulls as one byte array, and len + 1 offsets into it."""
    off = offsets_of(arr) if len(arr) else np.zeros(1, np.int64)
    data = arr.buffers()[2] if len(arr) else None
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def id_cuts(ids: DataFrame, n: int) -> list[int]:
    """At most n - 1 ids that cut the table (column doc_id) into n ranges of about equal rows."""
    q = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n)).first()[0] if n > 1 else None
    return sorted(set(q or []))


def range_of(c: Column, cuts: list[int], base: int = 0) -> Column:
    """Number of cuts at or below the id, by a tree of comparisons; null ids: -1."""
    if not cuts:
        return F.lit(base)
    k = len(cuts) // 2
    tree = F.when(c < cuts[k], range_of(c, cuts[:k], base)).otherwise(range_of(c, cuts[k + 1 :], base + k + 1))
    return F.coalesce(F.when(c.isNull(), -1), tree) if base == 0 else tree


def tasks(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# ---- words and their hashes over whole batches ---------------------------------------------

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_MULT = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def fold(buf: np.ndarray) -> np.ndarray:
    """A-Z to lower case."""
    return _FOLD[buf]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_MULT, pow(_MULT, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS


def word_spans(buf: np.ndarray, off: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of in_word bytes that stay within a document, and first[d]:
    the index of document d's first word (len(docs) + 1 values)."""
    n = len(buf)
    m = np.zeros(n + 2, bool)
    m[1:-1] = in_word[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(m[1:-1] & (~m[:-2] | edge[:-1]))
    ends = np.flatnonzero(m[1:-1] & (~m[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """64-bit hash of each word: a polynomial over its bytes from prefix sums, then mixed. Works block
    by block, so memory follows the block (or the longest word), not the text."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(int(np.searchsorted(ends, lo + block, "right")), i + 1)
        n = int(ends[j - 1]) - lo
        p, inverse = _powers(n + 1)
        s = np.zeros(n + 1, np.uint64)
        np.cumsum((buf[lo : lo + n].astype(np.uint64) + np.uint64(1)) * p[:n], out=s[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((s[b] - s[a]) * inverse[a] + (b - a).astype(np.uint64))
        i = j
    return out


SPACE_SPLIT = np.ones(256, bool)  # a word byte is any but [\x20\x09-\x0D]
SPACE_SPLIT[[9, 10, 11, 12, 13, 32]] = False


# ---- connected components ----------------------------------------------------------------------


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            up = new[new]
            if (up == new).all():
                break
            new = up
        if (new == root).all():
            break
        root = new
        live = root[a] != root[b]
        a, b = a[live], b[live]
    return root


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable over the links, for every node of a link.

    Alternates two steps until the links stop changing: each node hands its smallest neighbour to its
    larger neighbours, then to its smaller ones. The minimum per node is an aggregate with partial sums on
    the map side and returns to the links by a join that Spark may split, so a node with a third of all
    links stays spread over tasks. Links are written to the shared folder each round.
    """
    x, y = F.col(a), F.col(b)
    e = materialize(links.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    state = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = materialize(small.select("x.u", "x.v").filter("u != v").distinct())
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(e.select("v", "v").distinct())
