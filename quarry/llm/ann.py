"""Approximate nearest neighbours by shifted Hilbert curves.

Every vector (scaled to length 1) is projected on several random sets of ``dims`` directions, shifted, laid on a
grid and numbered along a Hilbert curve. Each curve's vectors are range-partitioned by that number and ranked; a
query looks at the keys around its own, up to the window's width on both sides, on every curve. What the curves
find is merged and reranked by the exact cosine, in double precision.

The window is measured, not guessed: a bounded sample of queries is compared to all rows by brute force, and the
window is the smallest in which the curves together find the share ``recall`` of their true neighbours. Vectors
without structure get wide windows, clustered ones narrow ones, at any size of the table.

Equal vectors are one item with its k + 1 smallest ids, which is all that a result can need of them, as ties go
to the smaller id; so a vector that fills a third of the table is one point of each curve.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import ordinal_rank
from ..session import materialize
from .common import ready

#: Rows of a curve in one block, the unit in which windows are read, and queries in one deal. Bounds a task's memory.
BLOCK = 2048
#: Queries whose true neighbours are found by brute force to measure the window: a documented, fixed bound.
SAMPLE = 256


# ---- Hilbert numbers --------------------------------------------------------------------------


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of x (n x d cells of `bits` bits, d * bits <= 63).

    The transpose form of the curve: reflections and exchanges of axes from the highest bit down, then a Gray code.
    """
    x = x.astype(np.int64).T.copy()
    d = len(x)
    for b in range(bits - 1, 0, -1):
        q, p = np.int64(1 << b), np.int64((1 << b) - 1)
        for i in range(d):
            on = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] = np.where(on, x[i], x[i] ^ t)
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t = np.where((x[d - 1] >> b) & 1, t ^ np.int64((1 << b) - 1), t)
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve_keys(v: np.ndarray, curves: int, dims: int, bits: int, seed: int) -> np.ndarray:
    """n x curves Hilbert numbers of vectors of length 1; the projections depend on seed and length of the vectors only."""
    n, size = v.shape
    out, dims = np.zeros((n, curves), np.int64), min(dims, size)
    for c in range(curves):
        rng = np.random.default_rng([seed, size, c])
        q, _ = np.linalg.qr(rng.standard_normal((size, size)))
        # A component of a unit vector is about 1 / sqrt(size); four times that on both sides, and a shift of a cell or less.
        y = (v @ q[:, :dims]) * np.sqrt(size) / 8 + 0.5 + rng.random(dims) / (1 << bits)
        out[:, c] = hilbert(np.clip((y * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1), bits)
    return out


# ---- the search -------------------------------------------------------------------------------


def _matrix(arr: pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(arr.to_pylist()), "<f8").reshape(n, -1)


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings the largest component to 0.5 or more and below 1, so that squares stay
    finite and above zero. Powers of two change no digit of a cosine."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def unit(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, summed in one fixed order."""
    q, v = scaled(q), scaled(v)
    return np.einsum("ij,ij->i", q, v) / (np.sqrt(np.einsum("ij,ij->i", q, q)) * np.sqrt(np.einsum("ij,ij->i", v, v)))


def items_of(df: DataFrame, id_col: str, vector_col: str, keep: int) -> tuple[DataFrame, DataFrame]:
    """(rows with id and item, items with vector bytes and their `keep` smallest ids) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & fine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, flat = b.column("v").offsets.to_numpy(), b.column("v").values.to_numpy(zero_copy_only=False) + 0.0  # -0.0 becomes 0.0
            data = [flat[s:e].astype("<f8").tobytes() for s, e in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(data, pa.binary())], ["vec_id", "vector"])

    rows = rows.mapInArrow(run, "vec_id long, vector binary").withColumn("item", F.unhex(F.md5("vector")))
    rows = materialize(rows)
    # Two levels: a vector that fills the table is cut to `keep` ids in 64 tasks before they meet.
    ids = rows.select("item", "vec_id").distinct()
    first = Window.partitionBy("item", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("vec_id")
    ids = ids.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= keep)
    ids = ids.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy("vec_id"))).filter(F.col("r") <= keep)
    ids = ids.groupBy("item").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    vectors = rows.groupBy("item").agg(F.min("vector").alias("vector"))
    return rows.select("vec_id", "item"), materialize(ids.join(vectors, "item").withColumn("size", (F.octet_length("vector") / 8).cast("int")))


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Row by row the columns of the k highest scores and of all equal to the last of them."""
    if score.shape[1] <= k:
        return np.ones(score.shape, bool)
    low = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
    return score >= low[:, None] - 1e-12


def nearest_in(q: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) numbers of each query's k nearest rows of v and those tied with them."""
    qs, vs = unit(q), unit(v)
    a, b = [], []
    for i in range(0, len(q), 1024):
        x, y = np.nonzero(_best(qs[i : i + 1024] @ vs.T, k))
        a.append(x + i)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def true_neighbours(items: DataFrame, sample: list, k: int) -> DataFrame:
    """(query, other): the k nearest items of each sampled one, by brute force; the sample is bounded."""
    ask = [(bytes(r["item"]), np.frombuffer(bytes(r["vector"]), "<f8")) for r in sample]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.asarray(b.column("size"))
            for size in np.unique(sizes).tolist():
                mine = [x for x in ask if len(x[1]) == size]
                at = np.flatnonzero(sizes == size)
                if not mine:
                    continue
                part, q = b.take(pa.array(at)), np.array([x[1] for x in mine])
                v = _matrix(part.column("vector"), len(at))
                x, y = nearest_in(q, v, k + 1)
                score = cosines(q[x], v[y])
                others = part.column("item").to_pylist()
                keep = [(mine[i][0], others[j], s) for i, j, s in zip(x.tolist(), y.tolist(), score.tolist()) if mine[i][0] != others[j]]
                cols = list(zip(*keep)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.float64())], ["query", "other", "score"])

    found = items.select("item", "vector", "size").mapInArrow(run, "query binary, other binary, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "other")
    return found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).select("query", "other")


def dealt(ranked: DataFrame, items: DataFrame, asking: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(members, queries, its columns named q_*) by size, curve, block and deal, where each query meets all in its window.

    A block is BLOCK neighbours on a curve, a deal BLOCK queries that follow each other there. A query goes to every
    block that its window meets, a block to every deal that has such a query, so both sides of a group are bounded.
    """
    on_curves = ranked.join(asking.select("item"), "item").select("item", "size", "curve", "rank")
    turns = ordinal_rank(on_curves, ["size", "curve"], ["rank"], out="turn")
    turns = turns.withColumn("deal", F.floor((F.col("turn") - 1) / BLOCK).cast("int")).select("item", "size", "curve", "rank", "deal")
    lo, hi = F.floor(F.greatest(F.col("rank") - window, F.lit(0)) / BLOCK), F.floor((F.col("rank") + window) / BLOCK)
    met = turns.withColumn("block", F.explode(F.sequence(lo.cast("int"), hi.cast("int"))))
    at = ["size", "curve", "block", "deal"]
    blocked = ranked.withColumn("block", F.floor(F.col("rank") / BLOCK).cast("int"))
    members = blocked.join(met.select(*at).distinct(), at[:3]).join(items.select("item", "vector", "ids"), "item").select(*at, "rank", "item", "vector", "ids")
    placed = met.join(asking.select("item", "vector"), "item")
    return members, placed.select(*[F.col(c).alias(f"q_{c}") for c in ("item", "vector", "rank", *at)])


def nearest_neighbours(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    curves: int = 16,
    dims: int = 8,
    bits: int = 7,
    recall: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every row whose id is divisible by `every`.

    score: the cosine of the original vectors in double precision; nearest first, ties to the smaller id. Null,
    zero and non-finite vectors and null ids take no part; vectors of different lengths are not compared. Rows
    that repeat an id and its vector are one row; an id with several vectors is found by any of them, and asks
    with each. Fewer candidates than k: all. An empty table gives an empty result.
    """
    ready(df)
    rows, items = items_of(df, id_col, vector_col, k + 1)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, names = np.asarray(b.column("size")), b.column("item").to_pylist()
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                v = _matrix(b.column("vector").take(pa.array(at)), len(at))
                key = curve_keys(unit(v), curves, dims, bits, seed)
                cols = [pa.array([names[i] for i in at] * curves, pa.binary()), pa.array(np.full(len(at) * curves, size, np.int32)),
                        pa.array(np.repeat(np.arange(curves, dtype=np.int32), len(at))), pa.array(key.T.ravel())]
                yield pa.RecordBatch.from_arrays(cols, ["item", "size", "curve", "key"])

    on_curves = items.select("item", "vector", "size").mapInArrow(keys, "item binary, size int, curve int, key long")
    ranked = materialize(ordinal_rank(on_curves, ["size", "curve"], ["key", "item"]).select("item", "size", "curve", "rank"))

    asked = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "item").distinct()
    asking = materialize(asked.select("item").distinct().join(items.select("item", "vector", "size"), "item"))
    # A repeatable sample, spread by the items' hashes.
    sample = asking.orderBy(F.xxhash64("item", F.lit(seed)), "item").limit(SAMPLE).collect()
    pairs = true_neighbours(items, sample, k)
    a = ranked.select(F.col("item").alias("query"), "curve", F.col("rank").alias("a"))
    b = ranked.select(F.col("item").alias("other"), F.col("curve").alias("c"), F.col("rank").alias("b"))
    apart = pairs.join(a, "query").join(b, "other").filter("curve = c").groupBy("query", "other").agg(F.min(F.abs(F.col("a") - F.col("b"))).alias("d"))
    window = apart.agg(F.expr(f"percentile_disc({recall}) within group (order by d)")).first()[0]
    window = max(1, int(window or 1))

    members, placed = dealt(ranked, items, asking, window)

    def search(key: tuple, m: pa.Table, q: pa.Table) -> pa.Table:
        found = []
        if m.num_rows and q.num_rows:
            m, q = m.combine_chunks(), q.combine_chunks()
            mr, qr = m.column("rank").to_numpy(), q.column("q_rank").to_numpy()
            v, w = _matrix(m.column("vector"), m.num_rows), _matrix(q.column("q_vector"), q.num_rows)
            order = np.argsort(mr)
            mr, v = mr[order], v[order]
            ids, names = m.column("ids").take(pa.array(order)).to_pylist(), q.column("q_item").to_pylist()
            vs, ws = unit(v), unit(w)
            for i in range(0, len(qr), 512):
                score = ws[i : i + 512] @ vs.T
                score[np.abs(mr[None, :] - qr[i : i + 512, None]) > window] = -np.inf
                x, y = np.nonzero(_best(score, k + 1) & (score > -np.inf))
                exact = cosines(w[x + i], v[y])
                found += [(names[a + i], c, s) for a, b, s in zip(x.tolist(), y.tolist(), exact.tolist()) for c in ids[b]]
        cols = list(zip(*found)) or [[], [], []]
        return pa.table({"item": pa.array(cols[0], pa.binary()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    at = ["size", "curve", "block", "deal"]
    found = members.groupBy(*at).cogroup(placed.groupBy(*[f"q_{c}" for c in at])).applyInArrow(search, "item binary, vec_id long, score double")
    merged = found.groupBy("item", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("item").orderBy(F.desc("score"), "vec_id")
    merged = merged.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")
    answers = asked.join(merged, "item").filter(F.col("vec_id") != F.col("query_id"))
    answers = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
