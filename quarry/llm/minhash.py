"""MinHash fingerprints of documents, their likeness, and near-duplicate classes by bands.

A document's shingles are runs of five words (A-Z folded, cut at ASCII white space; a shorter text is one
shingle). Each of 128 universal hash functions (a x + b mod 2^64 on shingle numbers) gives the smallest value
over the shingles, of which 16 bits are kept. The share of equal places estimates the Jaccard similarity. All of
it is numpy over whole Arrow slices; the words of a slice are hashed together.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import SPACE_SPLIT, bytes_of, connected_components, fold, id_and_text, id_cuts, mix, range_of, ready, slices, tasks, word_hashes, word_spans

PLACES, WORDS = 128, 5
_rng = np.random.default_rng(20240229)
_A = _rng.integers(1 << 62, size=PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1 << 63, size=PLACES, dtype=np.uint64)
_PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(buf: np.ndarray, off: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit shingle numbers of all documents as uint64, first shingle of each document, len + 1)."""
    buf = fold(buf)
    starts, ends, first = word_spans(buf, off, SPACE_SPLIT)
    w, n = word_hashes(buf, starts, ends), np.diff(first)
    many = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(many)])
    pos = np.repeat(first[:-1] - at[:-1], many) + np.arange(at[-1])
    end, h = np.repeat(first[1:], many), np.zeros(at[-1], np.uint64)
    for j in range(words):
        i = pos + j
        ok = i < end
        h[ok] += w[i[ok]] * _PLACE[j]
    return mix(h) >> np.uint64(32), at


def signatures(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """documents x 128 places of 16 bits; a document without words has zeros."""
    return _signatures(*shingles(buf, off))


def _signatures(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, PLACES), np.uint16)
    if len(full):
        v = np.empty_like(x)
        for k in range(PLACES):
            np.multiply(x, _A[k], out=v)
            v += _B[k]
            out[full, k] = mix(np.minimum.reduceat(v, at[full])) >> np.uint64(48)
    return out


def _binary(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint): 512 hex digits, one row per row of df; null texts are empty. Equal texts, equal fingerprints."""
    ready(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                sig = signatures(*bytes_of(b.column("text"))).astype(">u2")
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s.tobytes().hex() for s in sig])], ["doc_id", "fingerprint"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


def compare_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document against its edited text and the next document, in descending id order (null ids last).

    The edited text has the last floor(n_chars / 3) code points replaced by the first as many, or all, of the
    next document; after the last comes the first. (doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next). Rows with one id follow each other by their texts. A single
    row is its own next. Null texts are empty. An empty table gives an empty result.

    The texts cross the network once, to ranges of ids; the first row of each range is sent to the range
    before it as well, so every task has the next document of each of its rows.
    """
    return _neighbours(df, id_col, text_col).drop("class_id")


def neighbours_and_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """compare_neighbours with class_id, the near-duplicate class of the whole table that holds the document."""
    docs, classes = near_classes(df, id_col, text_col)
    classes = docs.select("doc_id", "item").join(classes, "item").filter(~F.col("class_id").eqNullSafe(F.col("doc_id"))).distinct()
    classes = materialize(classes.select("doc_id", "item", "class_id"))
    del docs
    release(df.sparkSession)
    return _neighbours(df, id_col, text_col, classes)


def _neighbours(df: DataFrame, id_col: str, text_col: str, classes: DataFrame | None = None) -> DataFrame:
    """classes: (doc_id, item, class_id) where class_id is not doc_id; they stand ahead of the texts of their id."""
    ready(df)
    n = tasks(df.sparkSession)
    docs = id_and_text(df, id_col, text_col)
    cuts = id_cuts(docs.select("doc_id"), 4 * n)
    docs = docs.withColumn("range", range_of(F.col("doc_id"), cuts))
    tops = {r["range"]: r["top"] for r in docs.groupBy("range").agg(F.max("doc_id").alias("top")).collect()}  # at most 4 n rows
    order = sorted(tops, reverse=True)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # of the first range: the last
    size = max(tops, default=0) + 2
    top = F.get(F.array(*[F.lit(tops.get(i - 1)).cast("long") for i in range(size)]), F.col("range") + 1)
    to = F.get(F.array(*[F.lit(before.get(i - 1)).cast("int") for i in range(size)]), F.col("range") + 1)
    own = F.struct(F.col("range").alias("range"), F.lit(0).alias("guest"))
    places = F.when(F.col("doc_id").eqNullSafe(top), F.array(own, F.struct(to.alias("range"), F.lit(1).alias("guest")))).otherwise(F.array(own))
    docs = docs.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.range", "p.guest", F.lit(None).cast("long").alias("item"), F.lit(None).cast("long").alias("class_id"))
    if classes is not None:
        docs = docs.union(classes.select("doc_id", F.lit(b"").alias("text"), range_of(F.col("doc_id"), cuts).alias("range"), F.lit(0), "item", "class_id"))
    keys = [F.desc("range"), "guest", F.desc_nulls_last("doc_id"), F.desc_nulls_last("item"), "text"]
    docs = docs.repartition(n, "range").sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, (None, {})  # (range, doc_id, text, signature, item, class) of the row that waits for its next
        for batch in batches:
            for b in slices(batch, "text", 2 << 20):
                x, at = shingles(*bytes_of(b.column("text")))
                sig, items, ranges, guests = _signatures(x, at), item_numbers(x, at), b.column("range").to_pylist(), b.column("guest").to_pylist()
                ids, texts, pairs = b.column("doc_id").to_pylist(), b.column("text").to_pylist(), []
                given, classed = b.column("item").to_pylist(), b.column("class_id").to_pylist()
                for i in range(b.num_rows):
                    if known[0] != (ranges[i], ids[i]):
                        known = (ranges[i], ids[i]), {}
                    if given[i] is not None:
                        known[1][given[i]] = classed[i]
                        continue
                    row = (ranges[i], ids[i], texts[i], sig[i], items[i], known[1].get(items[i], ids[i]))
                    if last is not None and last[0] == row[0]:
                        pairs.append((last, row))
                    last = None if guests[i] else row
                if pairs:
                    yield compared(pairs)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, class_id long"
    return docs.mapInArrow(run, schema)


def compared(pairs: list[tuple]) -> pa.RecordBatch:
    edited, lengths = [], []
    for (_, _, a, *_), (_, _, b, *_) in pairs:
        a, b = a.decode(), b.decode()
        k = len(a) // 3
        lengths.append(len(a))
        edited.append((a[: len(a) - k] + b[:k]).encode())
    mine, theirs = np.array([p[0][3] for p in pairs]), np.array([p[1][3] for p in pairs])
    after = signatures(*_binary(edited))
    cols = [
        pa.array([p[0][1] for p in pairs], pa.int64()), pa.array(lengths, pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in edited]),
        pa.array([s.tobytes().hex() for s in mine.astype(">u2")]), pa.array([s.tobytes().hex() for s in after.astype(">u2")]),
        pa.array((mine == after).mean(axis=1)), pa.array((mine == theirs).mean(axis=1)), pa.array([p[0][5] for p in pairs], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id"])


# ---- near-duplicate classes -------------------------------------------------------------------


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, bands: int | None = None, bucket_rows: int = 512) -> DataFrame:
    """(doc_id, class_id), one row per row of df: documents linked by a Jaccard similarity of `similarity` or more.

    class_id is the smallest id reachable; null ids: as in SimHash classes, no id of a class. See near_classes.
    """
    docs, classes = near_classes(df, id_col, text_col, similarity, bands, bucket_rows)
    return docs.select("doc_id", "item").join(classes, "item").select("doc_id", "class_id")


def bands_for(similarity: float) -> int:
    """The fewest bands in which a pair of this similarity is missed once in 10,000 at most; one place a band for the lowest."""
    places = [r for r in range(1, PLACES + 1) if (1 - similarity**r) ** (PLACES // r) <= 1e-4]
    return PLACES // max(places, default=1)


def near_classes(df: DataFrame, id_col: str, text_col: str, similarity: float = 0.8, bands: int | None = None, bucket_rows: int = 512) -> tuple[DataFrame, DataFrame]:
    """(rows with doc_id and item, (item, class_id)). Texts with one set of shingles are one item, so copies cost nothing.

    Signatures are cut into `bands`; items that share a band meet in its bucket, where the Jaccard similarity of
    their shingle sets is verified. Bands not given follow `similarity` (bands_for): a pair of similarity 0.8 shares one
    of 25 bands of 5 places with probability 0.9999. First each item is held against the smallest item of each of its buckets, a pair once however many
    bands it shares; that links most near copies. Where a bucket of three or more still has parts that are not
    linked, all pairs across its parts are compared, in blocks of bucket_rows; blocks of one part do not meet.
    Only ids and keys travel, and the sets of items that share a band, once for each of an item's hubs. Texts without words are one class.
    """
    if not 0 < similarity <= 1:
        raise ValueError("similarity is above 0 and at most 1")
    ready(df)
    bands = bands or bands_for(similarity)
    rows = PLACES // bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                x, at = shingles(*bytes_of(b.column("text")))
                sig, item = _signatures(x, at), item_numbers(x, at)
                keys = [[int.from_bytes(hashlib.blake2b(bytes([k]) + s[k * rows : (k + 1) * rows].tobytes(), digest_size=8).digest(), "big", signed=True) for k in range(bands)] if n else [] for s, n in zip(sig, np.diff(at))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(item, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "item", "keys"])

    texts = id_and_text(df, id_col, text_col)
    docs = materialize(texts.mapInArrow(run, "doc_id long, item long, keys array<long>"))
    # Half of a key is enough to leave out most keys that no other row has; copies pass and are told apart below.
    often = docs.select(F.explode("keys").alias("key")).select(F.expr("cast(key & 2147483647 as int)").alias("half")).groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = _marks(often, "half")

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, keys = b.column("keys").offsets.to_numpy(), b.column("keys").values.to_numpy()
            ok = _marked(shared, keys[off[0] : off[-1]])
            item = np.repeat(b.column("item").to_numpy(), np.diff(off))
            yield pa.RecordBatch.from_arrays([pa.array(item[ok]), pa.array(keys[off[0] : off[-1]][ok])], ["item", "key"])

    members = docs.select("item", "keys").mapInArrow(meeting, "item long, key long").distinct()
    hubs = members.groupBy("key").agg(F.min("item").alias("hub"), F.max("item").alias("top")).filter("hub != top").select("key", "hub")
    members = materialize(members.join(hubs, "key").select("key", "item", "hub"))

    def sets_of(items: DataFrame) -> DataFrame:
        """(item, set) of the items in the column item, and of some others; made again from the texts."""
        wanted = _marks(items.distinct(), "item")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b in slices(batch, "text"):
                    x, at = shingles(*bytes_of(b.column("text")))
                    item = np.array(item_numbers(x, at), np.int64)
                    once = {int(item[i]): i for i in np.flatnonzero(_marked(wanted, item)).tolist()}
                    sets = [np.unique(x[at[i] : at[i + 1]]).astype("<u4").tobytes() for i in once.values()]
                    yield pa.RecordBatch.from_arrays([pa.array(list(once), pa.int64()), pa.array(sets, pa.binary())], ["item", "set"])

        return texts.mapInArrow(run, "item long, set binary").dropDuplicates(["item"])

    # The items of a hub, in groups of bounded size, each with the hub's set first.
    pairs = members.filter("item != hub").select("item", "hub").distinct()
    size = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / (8 * bucket_rows)).alias("groups"))
    own = size.select(F.col("hub").alias("item"), "hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("g"))
    met = pairs.join(size, "hub").select("item", "hub", F.pmod(F.xxhash64("item"), F.col("groups")).alias("g")).union(own)
    met = sets_of(members.select("item")).join(met, "item")
    met = met.repartition("hub", "g").sortWithinPartitions("hub", "g", F.col("item") != F.col("hub")).select("item", "hub", "set")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for b in batches:
            near = []
            for i, h, s in zip(b.column("item").to_pylist(), b.column("hub").to_pylist(), b.column("set").to_pylist()):
                s = np.frombuffer(s, "<u4")
                first = s if i == h else first
                near.append(i != h and _near(first, s, similarity))
            yield b.select(["item", "hub"]).filter(pa.array(near, pa.bool_())).rename_columns(["a", "b"])

    links = materialize(met.mapInArrow(verify, "a long, b long"))
    parts = materialize(connected_components(links))

    # Buckets in which something is left to compare; of buckets with the same items one is enough.
    rooted = members.join(parts, F.col("item") == F.col("node"), "left").select("key", "item", F.coalesce("root", "item").alias("root"))
    left = rooted.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("top"), F.expr("bit_xor(xxhash64(item))").alias("x"), F.expr("bit_xor(xxhash64(item, 7))").alias("y"))
    left = left.filter("n > 2 and low != top").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key")
    open_ = materialize(rooted.join(left, "key"))
    if not open_.isEmpty():
        more = materialize(_across(open_, sets_of(open_.select("item")), similarity, bucket_rows))
        parts = materialize(connected_components(links.union(more)))

    items = docs.groupBy("item").agg(F.min("doc_id").alias("low"))
    rooted = items.join(parts, F.col("item") == F.col("node"), "left").select("item", "low", F.coalesce("root", "item").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("class_id"))
    return docs, materialize(rooted.join(lows, "root").select("item", "class_id"))


def _across(members: DataFrame, sets: DataFrame, similarity: float, bucket_rows: int) -> DataFrame:
    """Links (a, b) between items of different roots in each bucket of (key, item, root), all pairs compared.

    A root with bucket_rows items or more in the bucket has blocks of its own, the others share blocks.
    """
    size = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    size = size.withColumn("pure", F.when(F.col("n") >= bucket_rows, F.col("root")))
    count = size.groupBy("key", "pure").agg(F.sum("n").alias("n")).withColumn("blocks", F.ceil(F.col("n") / bucket_rows))
    count = count.select(F.col("key").alias("k"), F.col("pure").alias("p"), "blocks")
    blocks = count.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("k", "p", F.xxhash64("k", F.coalesce("p", F.lit(0)), F.col("p").isNull(), "j").alias("block"))
    met = blocks.join(blocks.select(F.col("k").alias("l"), F.col("p").alias("q"), F.col("block").alias("to")), F.col("k") == F.col("l"))
    met = met.filter("block <= to and not coalesce(p = q, false)").select(F.xxhash64("block", "to").alias("pair"), F.explode(F.array_distinct(F.array("block", "to"))).alias("at"))
    placed = members.join(size.select("key", "root", "pure"), ["key", "root"])
    placed = placed.join(count, (F.col("key") == F.col("k")) & F.col("pure").eqNullSafe(F.col("p")))
    placed = placed.select("item", "root", F.xxhash64("key", F.coalesce("pure", F.lit(0)), F.col("pure").isNull(), F.pmod(F.xxhash64("item"), F.col("blocks"))).alias("at"))
    placed = placed.join(met, "at").join(sets, "item").select("pair", "item", "root", "set")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, item, root, held = None, [], [], []
        for b in batches:
            for p, i, r, s in zip(b.column("pair").to_pylist(), b.column("item").to_pylist(), b.column("root").to_pylist(), b.column("set").to_pylist()):
                if p != pair and item:
                    yield _forest(item, root, held, similarity)
                    item, root, held = [], [], []
                pair = p
                item.append(i)
                root.append(r)
                held.append(np.frombuffer(s, "<u4"))
        if item:
            yield _forest(item, root, held, similarity)

    return placed.repartition("pair").sortWithinPartitions("pair", "item").mapInArrow(compare, "a long, b long")


#: Most bits of a table of marks. More marks than fit let more rows through; the joins behind are exact.
MARK_BITS = 25


def _marks(df: DataFrame, c: str) -> np.ndarray:
    """A bit table of the 64-bit hashes in column c, for the tasks to leave out most rows that no join will meet."""
    bits = min(MARK_BITS, max(16, (16 * df.count()).bit_length()))
    at = df.select(F.pmod(F.col(c), F.lit(1 << bits)).alias("v")).groupBy(F.shiftright("v", 6).alias("w"))
    words = at.agg(F.expr("bit_or(shiftleft(1L, cast(v & 63 as int)))").alias("m")).toArrow()
    out = np.zeros(1 << bits >> 6, np.int64)
    out[words.column("w").to_numpy()] = words.column("m").to_numpy()
    return out


def _marked(marks: np.ndarray, v: np.ndarray) -> np.ndarray:
    v = v & np.int64(64 * len(marks) - 1)
    return (marks[v >> 6] >> (v & 63)) & 1 == 1


def item_numbers(x: np.ndarray, at: np.ndarray) -> list[int]:
    """A 64-bit number of each document's set of shingles."""
    return [int.from_bytes(hashlib.blake2b(np.unique(x[s:e]).astype("<u4").tobytes(), digest_size=8).digest(), "big", signed=True) for s, e in zip(at[:-1], at[1:])]


def _forest(item: list[int], root: list[int], sets: list[np.ndarray], similarity: float) -> pa.RecordBatch:
    """Links between the parts (items of one root) of a bucket, as many as join what can be joined."""
    a, b, size = [], [], np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    at, mark = np.concatenate([[0], np.cumsum(size)]), np.zeros(int(codes.max()) + 1, bool)
    part = np.unique(np.array(root, np.int64), return_inverse=True)[1]
    for x in range(len(item)):
        y = np.flatnonzero((part != part[x]) & (np.arange(len(item)) > x) & (np.minimum(size, size[x]) / np.maximum(size, size[x]) >= similarity))
        if not len(y):
            continue
        mark[codes[at[x] : at[x + 1]]] = True
        both = np.array([np.count_nonzero(mark[codes[at[i] : at[i + 1]]]) for i in y.tolist()])
        mark[codes[at[x] : at[x + 1]]] = False
        for i in y[both / (size[y] + size[x] - both) >= similarity].tolist():
            if part[i] != part[x]:
                a.append(item[x])
                b.append(item[i])
                part[part == part[i]] = part[x]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _near(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets have that Jaccard similarity; their sizes alone refuse most pairs that have not."""
    if min(len(a), len(b)) / max(len(a), len(b)) < similarity:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) >= similarity
