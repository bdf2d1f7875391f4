"""Best-fit packing of documents into sequences, improved by swap-based local search.

Pieces are dealt to groups of about ``group_rows`` pieces, one task each. A group is packed best-fit, longest
first; while it has more sequences than its tokens need, a local search works on the underfull ones: a document
moves to another sequence, is exchanged for one or for two shorter ones, or two are for one. Each step makes a sequence
fuller than the other was, so the sum of squared fills grows; emptied sequences are gone. The search ends at a local
optimum: no move and no exchange of these kinds is left. Sequences that stay less than ``good_fill`` full are taken apart
and packed again with those of other groups, round after round, until a round lowers no number of sequences.
"""

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import id_and_text, ready, slices
from .tokens import encoder, vocabulary


def pieces(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end_id: int = 1,
    vocabulary_path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every text's ids and end_id, cut where over capacity.

    Null texts are empty and have one piece of one token. Repeated rows and null ids are documents like
    others. Other columns are ignored.
    """
    ready(df)
    where = vocabulary_path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(where)
        for batch in batches:
            for b in slices(batch, "text"):
                ids, first = enc.encode(b.column("text").cast(pa.string()), end_id)
                data, n = ids.astype("<u4").tobytes(), np.diff(first)
                k = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), k)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                lo = ((first[row] + start) * 4).tolist()
                hi = ((first[row] + start + length) * 4).tolist()
                crc = [zlib.crc32(memoryview(data)[x:y]) for x, y in zip(lo, hi)]
                cols = [b.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array([data[x:y] for x, y in zip(lo, hi)], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return id_and_text(df, id_col, text_col).mapInArrow(run, schema)


# ---- one group ----------------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Longest first, each item into the fullest bin that has room; bins as lists of item numbers."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0  # bit g: a bin with gap g exists
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = gaps >> n
        if fits:
            g = n + ((fits & -fits).bit_length() - 1)
            b = by_gap[g].pop()
            if not by_gap[g]:
                gaps &= ~(1 << g)
            bins[b].append(i)
        else:
            g, b = capacity, len(bins)
            bins.append([i])
        by_gap[g - n].append(b)
        gaps |= 1 << (g - n)
    return bins


class _Search:
    """Local search between underfull bins. A step raises the fill of a bin b by d, at the cost of a bin v, where b
    then is fuller than v was, so the sum of squared fills grows: a document moves, or is exchanged for a shorter one,
    for two that are shorter together, or two for a shorter one. Documents and pairs of documents of one bin stand in
    order of their lengths, so those that fit a bin's gap are a range, searched from its longest."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int):
        self.order = np.argsort(lengths, kind="stable")
        place = np.empty(len(lengths), np.int64)
        place[self.order] = np.arange(len(lengths))
        self.n, self.capacity = lengths[self.order], capacity
        self.members = [place[b].tolist() for b in bins]
        self.at = np.empty(len(lengths), np.int64)
        for k, b in enumerate(self.members):
            self.at[b] = k
        self.fill = np.bincount(self.at, self.n, len(bins)).astype(np.int64)
        self.changes = np.zeros(len(bins), np.int64)
        self.alive, self.need = len(bins), -(-int(lengths.sum()) // capacity)

    def run(self) -> list[list[int]]:
        """Until as few bins are left as the tokens need, or no step is left."""
        while self.alive > self.need and (self._sweep(self._singles) or self._sweep(self._pairs)):
            pass
        return [self.order[b].tolist() for b in self.members if b]

    def _sweep(self, prepare) -> bool:
        """Every step of some kinds into each underfull bin, the fullest first; whether there was one."""
        find, found = prepare(), False
        bins = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
        for b in bins[np.argsort(-self.fill[bins], kind="stable")].tolist():
            while self.alive > self.need and 0 < self.fill[b] < self.capacity:
                step = find(b)
                if step is None:
                    break
                self._apply(b, *step)
                found = True
        return found

    def _apply(self, b: int, take: list[int], give: list[int]) -> None:
        v = int(self.at[take[0]])
        for here, there, items in ((v, b, take), (b, v, give)):
            for i in items:
                self.members[here].remove(i)
                self.members[there].append(i)
                self.at[i] = there
                self.fill[here] -= self.n[i]
                self.fill[there] += self.n[i]
            self.changes[here] += 1
        self.alive -= not self.members[v]

    def _distinct(self, b: int) -> list[int]:
        """A document of each length in a bin."""
        return list({int(self.n[i]): i for i in self.members[b]}.values())

    def _pairs_of(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """A pair of documents for each two lengths in a bin."""
        held = np.sort(np.array(self.members[b], np.int64))
        n = self.n[held]
        # Two of a length are enough.
        held = held[(np.concatenate([[-1, -1], n[:-2]]) != n)[: len(held)]]
        x, y = np.triu_indices(len(held), 1)
        return held[x], held[y]

    def _longest(self, b: int, given: int, sums: np.ndarray, keys: list[int], bin_of, least: int) -> int | None:
        """The last entry of sums, sorted, that can come to bin b for `given` tokens and raises it by more than least."""
        room = self.capacity - int(self.fill[b])
        hi, low = bisect_right(keys, given + room), bisect_right(keys, given + least)
        while hi > low:
            lo = max(low, hi - 128)
            v = bin_of(lo, hi)
            fills = np.where(v >= 0, self.fill[v], self.capacity)
            ok = np.flatnonzero((v != b) & (fills < self.capacity) & (fills < self.fill[b] - given + sums[lo:hi]))
            if len(ok):
                return lo + int(ok[-1])
            hi = lo
        return None

    def _singles(self):
        """Moves and exchanges of one for one."""
        items = np.flatnonzero(self.fill[self.at] < self.capacity)
        sums, room = self.n[items], self.capacity
        keys, bin_of = sums.tolist(), lambda lo, hi: self.at[items[lo:hi]]

        def find(b: int):
            best, gain = None, 0
            for i in [None, *self._distinct(b)]:
                given = 0 if i is None else int(self.n[i])
                k = self._longest(b, given, sums, keys, bin_of, gain)
                if k is not None:
                    best, gain = ([int(items[k])], [] if i is None else [i]), keys[k] - given
                    if gain == room - self.fill[b]:
                        break
            return best

        return find

    def _pairs(self):
        """Exchanges of two for one and one for two."""
        bins = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
        made = [self._pairs_of(b) for b in bins.tolist()] or [(np.zeros(0, np.int64),) * 2]
        x, y = (np.concatenate(c) for c in zip(*made))
        order = np.argsort(self.n[x] + self.n[y], kind="stable")
        x, y = x[order], y[order]
        sums, home, version = self.n[x] + self.n[y], self.at[x].copy(), self.changes.copy()
        keys, room = sums.tolist(), self.capacity
        items = np.flatnonzero(self.fill[self.at] < self.capacity)
        ones, one_keys = self.n[items], self.n[items].tolist()

        def two_of(lo: int, hi: int) -> np.ndarray:
            h = home[lo:hi]
            return np.where(self.changes[h] == version[h], h, -1)  # pairs of changed bins wait for the next sweep

        def one_of(lo: int, hi: int) -> np.ndarray:
            return self.at[items[lo:hi]]

        def find(b: int):
            best, gain = None, 0
            for i in self._distinct(b):
                given = int(self.n[i])
                k = self._longest(b, given, sums, keys, two_of, gain)
                if k is not None:
                    best, gain = ([int(x[k]), int(y[k])], [i]), keys[k] - given
                    if gain == room - self.fill[b]:
                        return best
            p, q = self._pairs_of(b)
            for i, j in zip(p.tolist(), q.tolist()):
                given = int(self.n[i] + self.n[j])
                k = self._longest(b, given, ones, one_keys, one_of, gain)
                if k is not None:
                    best, gain = ([int(items[k])], [i, j]), one_keys[k] - given
                    if gain == room - self.fill[b]:
                        return best
            return best

        return find


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """The bins after a local search that ends where no step helps, or where no packing can have fewer bins."""
    return _Search(bins, lengths, capacity).run()


def pack_group(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item."""
    bins = improve(best_fit(lengths, capacity), lengths, capacity)
    out = np.zeros(len(lengths), np.int64)
    for k, b in enumerate(bins):
        out[b] = k
    return out


# ---- all groups -----------------------------------------------------------------------------------


def pack(
    df: DataFrame,
    length_col: str = "length",
    capacity: int = 4096,
    group_rows: int = 20_000,
    good_fill: float = 0.99,
) -> DataFrame:
    """df with sequence_id (long) and offset (long): every row is placed, sequences hold at most `capacity`.

    Within a sequence the rows follow each other without gaps from offset 0. Null lengths count as 0, rows of
    length 0 take no room; a length over capacity or under 0 is an error. Columns sequence_id and offset of df
    are replaced. Equal lengths are told apart by the rows' written order. An empty table stays empty.
    """
    ready(df)
    names = [c for c in df.columns if c not in ("sequence_id", "offset")]
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    n_col = F.coalesce(F.col(f"`{length_col}`").cast("long"), F.lit(0))
    bad = F.raise_error(F.concat(F.lit("length outside 0 and capacity: "), n_col.cast("string")))
    x = materialize(df.select(row, F.when((n_col >= 0) & (n_col <= capacity), n_col).otherwise(bad.cast("long")).alias("n")))
    # The written rows have a fixed order, so this number is the same in every pass; it deals equal rows evenly.
    x = x.withColumn("number", F.monotonically_increasing_id())
    rows, placed = materialize(x.select("number", "n")), []
    left, level, before = rows.count(), 0, None
    underfull = F.col("fill") < int(good_fill * capacity)
    while left:
        groups = -(-left // group_rows)
        dealt = rows.withColumn("g", F.pmod(F.xxhash64("number", F.lit(level)), F.lit(groups)).cast("int"))
        done = materialize(dealt.groupBy("g").applyInPandas(_packer(capacity, level), "number long, n long, sequence_id long, offset long, fill long"))
        # A sequence's first row stands for it.
        first = (F.col("offset") == 0) & ((F.col("n") > 0) | (F.col("fill") == 0))
        now, again, open_ = done.agg(F.count_if(first), F.count_if(underfull), F.count_if(underfull & first)).first()
        if groups == 1 or not again or (before is not None and now >= before):
            placed.append(done)  # there is nothing to mix it with, or mixing has lowered no number of sequences
            break
        placed.append(done.filter(~underfull))
        rows, left, level, before = done.filter(underfull).select("number", "n"), again, level + 1, open_
    if not placed:
        return x.select("row.*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    where = placed[0]
    for p in placed[1:]:
        where = where.union(p)
    return x.select("number", "row").join(where.select("number", "sequence_id", "offset"), "number").select("row.*", "sequence_id", "offset")


def _packer(capacity: int, level: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("number", ignore_index=True)
        n = pdf["n"].to_numpy(np.int64)
        b = pack_group(n, capacity)
        order = np.argsort(b, kind="stable")
        before = np.cumsum(n[order]) - n[order]
        start = np.zeros(int(b.max()) + 1, np.int64)
        first = np.flatnonzero(np.diff(b[order], prepend=-1))
        start[b[order][first]] = before[first]
        offset = np.empty(len(n), np.int64)
        offset[order] = before - start[b[order]]
        fill = np.bincount(b, n).astype(np.int64)
        return pd.DataFrame({"number": pdf["number"], "n": n, "sequence_id": (np.int64(level) << 56) | (np.int64(int(key[0])) << 28) | b, "offset": offset, "fill": fill[b]})

    return run


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1, with_ids: bool = False, vocabulary_path: str | None = None, **options) -> DataFrame:
    """The pieces of every document, each with its place: sequence_id and offset."""
    return pack(pieces(df, id_col, text_col, capacity, end_id, vocabulary_path, with_ids), "length", capacity, **options)
