"""How far the sources of a language diverge, by hash-consed segment trees over term ids.

Terms are counted per (language, source) group; a language keeps those of at least ``min_docs`` of its documents and
numbers them by falling frequency. A group's counts over these numbers are the leaves of a segment tree. Trees are
hash-consed: a node is its pair of children, and subtrees with identical counts are one node, whatever group and
place they stand in (rare terms leave most of a small group's tree to the node of zeros).

Two groups are compared by a simultaneous traversal of their trees from the roots down. The pairs of nodes met on
a level are merged with how often they are met, so a pair of nodes is followed, and a pair of counts priced, once.
Both directions of a pair come from one traversal.

The trees are cut at BLOCK terms, and the groups of a language are dealt in tiles of TILE, so a task never holds
more than two tiles' subtrees of one block; the prices of the blocks are summed. All arithmetic is in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import ordinal_rank
from ..session import materialize
from .common import bytes_of, ready, slices, tasks, word_spans

#: Terms of a subtree that one task builds (a power of two), and groups of a tile.
BLOCK, TILE = 4096, 32
#: Pairs of leaves that a traversal may hold at once.
MOST_PAIRS = 1 << 20
MAX_BROADCAST_GROUPS = 1_000_000
PADDING = -1

#: Term bytes: letters and all of multi-byte characters.
TERM = np.zeros(256, bool)
TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


# ---- counting -------------------------------------------------------------------------------------


def count_terms(df: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of rows (lang, source, text binary): occurrences, and rows that hold the term."""
    ready(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 8 << 20):
                buf, off = bytes_of(b.column("text"))
                starts, ends, first = word_spans(buf, off, TERM)
                if not len(starts):
                    continue
                data = LOWER[buf[TERM[buf]]]
                ends_at = np.concatenate([[0], np.cumsum(ends - starts)])
                words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_at), pa.py_buffer(data)])
                coded = words.dictionary_encode()
                code, k = np.asarray(coded.indices).astype(np.int64), len(coded.dictionary)
                docs = np.repeat(np.arange(b.num_rows), np.diff(first))
                pairs, n = np.unique(docs * k + code, return_counts=True)
                langs, sources = (b.column(c).dictionary_encode() for c in ("lang", "source"))
                group = np.asarray(langs.indices).astype(np.int64) * len(sources.dictionary) + np.asarray(sources.indices)
                keys, at = np.unique(group[pairs // k] * k + pairs % k, return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, at, n)
                g = keys // k
                cols = [
                    langs.dictionary.take(pa.array(g // len(sources.dictionary))),
                    sources.dictionary.take(pa.array(g % len(sources.dictionary))),
                    coded.dictionary.take(pa.array(keys % k)).cast(pa.binary()),
                    pa.array(total),
                    pa.array(np.bincount(at, minlength=len(keys))),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "n", "docs"])

    counts = df.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counts.withColumn("term", F.col("term").cast("string"))


# ---- prices ---------------------------------------------------------------------------------------


def share(count: str, total: str) -> Column:
    """1 + floor(10 ** 9 * (count + 1) / total), in two steps that stay within a long for totals below 9 * 10 ** 14."""
    top = f"(({count} + 1) * 100000L)"
    return F.expr(f"1 + {top} div ({total}) * 10000 + ({top} % ({total}) * 10000) div ({total})")


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    top = (count + 1) * 100_000
    return 1 + top // total * 10_000 + top % total * 10_000 // total


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


# ---- trees ----------------------------------------------------------------------------------------


class Forest:
    """The hash-consed trees of some groups over one block of terms."""

    def __init__(self, leaves: np.ndarray):
        """leaves: groups x terms (a power of two), PADDING behind the last term."""
        self.counts, nodes = np.unique(leaves, return_inverse=True)
        nodes = nodes.reshape(leaves.shape)
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        while nodes.shape[1] > 1:
            n = int(nodes.max()) + 1
            keys, at = np.unique(nodes[:, ::2].astype(np.int64) * n + nodes[:, 1::2], return_inverse=True)
            self.children.append((keys // n, keys % n))
            nodes = at.reshape(nodes.shape[0], -1)
        self.roots = nodes[:, 0]

    def meets(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pair, count in a, count in b, times) of the pairs of groups a[i], b[i]: each pair of counts once."""
        pair, x, y, times = np.arange(len(a)), self.roots[a], self.roots[b], np.ones(len(a), np.int64)
        for left, right in self.children[::-1]:
            pair, times = np.concatenate([pair, pair]), np.concatenate([times, times])
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            n = int(max(x.max(), y.max())) + 1
            keys, at = np.unique((pair * n + x) * n + y, return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, at, times)
            pair, x, y, times = keys // (n * n), keys // n % n, keys % n, total
        real = self.counts[x] != PADDING
        return pair[real], self.counts[x[real]], self.counts[y[real]], times[real]


def _sums(pair: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    if float(np.sum(values.astype(np.float64))) > 9e18 and max(np.bincount(pair, values.astype(np.float64))) > 9e18:
        raise OverflowError("a sum of prices leaves 64 bits")
    out = np.zeros(n, np.int64)
    np.add.at(out, pair, values)
    return out


def block_prices(leaves: np.ndarray, totals: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Price of each pair of groups a[i], b[i] over a block, seen from a and from b."""
    forest, there, back = Forest(leaves), [], []
    step = max(1, MOST_PAIRS // leaves.shape[1])
    for i in range(0, len(a), step):
        u, v = a[i : i + step], b[i : i + step]
        pair, cu, cv, times = forest.meets(u, v)
        p, q = shares(cu, totals[u][pair]), shares(cv, totals[v][pair])
        there.append(_sums(pair, price(p, q) * times, len(u)))
        back.append(_sums(pair, price(q, p) * times, len(u)))
    return np.concatenate([*there, np.zeros(0, np.int64)]), np.concatenate([*back, np.zeros(0, np.int64)])


def _pairs(low: np.ndarray, high: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of groups of two tiles, or of one, once."""
    if same:
        x, y = np.triu_indices(len(low), 1)
        return low[x], low[y]
    return np.repeat(low, len(high)), np.tile(high, len(low))


KEYS = ["lang", "block", "low", "high"]


def _traverse(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Prices of the pairs of groups of two tiles over a block of `size` terms, from the rows of one of KEYS each."""

    def priced(key: tuple, rows: list[dict]) -> pa.RecordBatch:
        lang, block, low, high = key
        terms = rows[0]["v"] - block * size
        leaves = np.zeros((len(rows), size), np.int64)
        leaves[:, max(0, min(terms, size)) :] = PADDING
        for i, r in enumerate(rows):
            leaves[i, r["ids"]] = r["counts"]
        totals = np.array([max(1, r["total"] + r["v"]) for r in rows])
        tile = np.array([r["tile"] for r in rows])
        a, b = _pairs(np.flatnonzero(tile == low), np.flatnonzero(tile == high), low == high)
        there, back = block_prices(leaves, totals, a, b)
        name = np.array([r["source"] for r in rows], object)
        ends = [np.concatenate([name[a], name[b]]), np.concatenate([name[b], name[a]])]
        cols = [pa.array([lang] * 2 * len(a), pa.string()), pa.array(ends[0], pa.string()), pa.array(ends[1], pa.string()), pa.array(np.concatenate([there, back]))]
        return pa.RecordBatch.from_arrays(cols, ["lang", "source", "item", "value"])

    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in KEYS)
            if held and key != at:
                yield priced(at, held)
                held = []
            at = key
            held.append(row)
    if held:
        yield priced(at, held)


# ---- the audit ------------------------------------------------------------------------------------


def _joined(x: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Join with a materialised table of groups, sent to all tasks if it is small."""
    return x.join(F.broadcast(side) if side.count() <= MAX_BROADCAST_GROUPS else side, on)


def audit_sources(
    df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 3, top: int = 200, block: int = BLOCK, tile: int = TILE
) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` prices each group against every other of its language,
    part `term` ranks the terms that a group uses more than its language does.

    Null languages, sources and texts are empty strings. Every row is a document, also one that repeats. A group
    without terms has its pairs (value 0 where its language keeps no term) and no term rows. Ties go to the item that
    comes first in UTF-8. An empty table gives no row; other columns are ignored."""
    ready(df)
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    docs = df.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).cast("binary").alias("text"))
    counts = materialize(count_terms(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), (-F.sum("n")).alias("less")).filter(F.col("docs") >= min_docs)
    kept = ordinal_rank(kept.select("lang", "term", "less"), ["lang"], ["less", "term"], out="id")
    found = materialize(
        counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", (-F.col("less")).alias("all"), (F.col("id") - 1).alias("id"))
    )
    # One row a group and one a language: sums with partials.
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), (-F.sum("less")).alias("lang_total"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "v", "lang_total")])
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int")
    groups = materialize(groups.withColumn("tile", F.floor(number / tile).cast("int")))
    tiles = groups.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"))
    return _pair_rows(found, groups, tiles, block).unionByName(_term_rows(found, groups, top))


def _ranked(x: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    x = x.withColumn("rank", F.row_number().over(order).cast("int"))
    x = x.filter(F.col("rank") <= top) if top else x
    return x.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _term_rows(found: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    x = _joined(found, groups, ["lang", "source"])
    x = x.withColumn("p", share("n", "total + v")).withColumn("q", share("all", "lang_total + v"))
    x = x.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))
    return _ranked(x, "term", top)


def _pair_rows(found: DataFrame, groups: DataFrame, tiles: DataFrame, size: int) -> DataFrame:
    leaf = found.select("lang", "source", F.floor(F.col("id") / size).cast("long").alias("block"), F.pmod("id", F.lit(size)).cast("int").alias("at"), "n")
    # At most `size` leaves a row.
    leaf = leaf.groupBy("lang", "source", "block").agg(F.collect_list(F.struct("at", "n")).alias("leaves"))
    blocks = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("v") / size), F.lit(1)).cast("long") - 1)).alias("block")
    x = groups.select("lang", "source", "total", "v", "tile", blocks).join(leaf, ["lang", "source", "block"], "left")
    x = x.join(tiles, "lang").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    x = x.select(
        "lang", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "source", "total", "v", "tile",
        F.coalesce(F.col("leaves.at"), F.array().cast("array<int>")).alias("ids"), F.coalesce(F.col("leaves.n"), F.array().cast("array<long>")).alias("counts"),
    )
    x = x.repartition(tasks(found.sparkSession), *KEYS).sortWithinPartitions(*KEYS, "source")
    x = x.mapInArrow(lambda batches: _traverse(batches, size), "lang string, source string, item string, value long")
    return _ranked(x.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pair")
