"""Token ids as directly addressable codes, with random access to any token.

An id is split into 8-bit chunks, lowest first. Level k holds the k-th chunk of every id that has one, as a
byte array, with a bitmap that says which of these ids go on in level k + 1 and a rank directory (set bits
before each 512) that says where. Token i is read by at most four byte look-ups; no block is decoded.

A segment is one self-contained file image (bytes): magic, counts, the document directory (ids, first
token), then the levels. Segments hold whole documents in ascending id order and about ``segment_tokens``
tokens; a longer document has a segment of its own. They are kept as binary values of a Parquet table,
as Spark's writers (and no local file) reach every store; a row also has the segment's place and counts.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_and_text, id_cuts, range_of, ready, slices, tasks
from .tokens import encoder, vocabulary

MAGIC, BLOCK = b"DAC1", 512
SEGMENT = "range int, segment int, n_docs long, n_tokens long, image binary"


def build(ids: np.ndarray, doc_ids: list[int | None], first: np.ndarray) -> bytes:
    """The file image of documents with the given ids; document d has tokens first[d] to first[d + 1]."""
    parts = [np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], np.uint8).tobytes()]
    parts.append(first.astype("<i8").tobytes())
    levels, rest = 0, ids.astype(np.uint32)
    while levels == 0 or len(rest):
        more = rest >> 8
        on = more > 0
        bitmap = np.packbits(on, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(on, np.arange(0, len(on), BLOCK), dtype=np.int64))]) if len(on) else np.zeros(1)
        parts += [struct.pack("<q", len(rest)), (rest & 255).astype(np.uint8).tobytes(), bitmap.tobytes(), ranks.astype("<u4").tobytes()]
        rest, levels = more[on], levels + 1
    return MAGIC + struct.pack("<qqq", levels, len(doc_ids), len(ids)) + b"".join(parts)


class Segment:
    """Reads a file image in place."""

    def __init__(self, image: bytes):
        if image[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        n_levels, n_docs, self.n = struct.unpack_from("<qqq", image, 4)
        self.at, self.image = 28, image
        ids, null = self._take("<i8", n_docs), self._take(np.uint8, n_docs)
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, null)]
        self.first, self.levels = self._take("<i8", n_docs + 1), []
        for _ in range(n_levels):
            n = int(self._take("<i8", 1)[0])
            chunk, bitmap = self._take(np.uint8, n), self._take(np.uint8, -(-n // 8))
            self.levels.append((chunk, bitmap, self._take("<u4", -(-n // BLOCK) + 1)))

    def _take(self, kind, n: int) -> np.ndarray:
        out = np.frombuffer(self.image, kind, n, self.at)
        self.at += out.nbytes
        return out

    def _rank(self, level: int, i: int) -> int:
        """Set bits before i."""
        _, bitmap, ranks = self.levels[level]
        lo = i // BLOCK * BLOCK // 8
        whole = int(np.bitwise_count(bitmap[lo : i // 8]).sum())
        last = int(bitmap[i // 8]) & ((1 << i % 8) - 1) if i % 8 else 0
        return int(ranks[i // BLOCK]) + whole + last.bit_count()

    def token(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level, (chunk, bitmap, _) in enumerate(self.levels):
            out |= int(chunk[i]) << 8 * level
            if not bitmap[i // 8] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return out

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """The ids at positions lo to hi - 1, as unsigned 32-bit integers."""
        out, at = np.zeros(max(0, hi - lo), np.uint32), np.arange(max(0, hi - lo))
        for level, (chunk, bitmap, _) in enumerate(self.levels):
            if hi <= lo:
                break
            out[at] |= chunk[lo:hi].astype(np.uint32) << np.uint32(8 * level)
            on = np.unpackbits(bitmap[lo // 8 : -(-hi // 8)], bitorder="little")[lo % 8 : lo % 8 + hi - lo].astype(bool)
            at = at[on]
            lo = self._rank(level, lo)
            hi = lo + len(at)
        return out


def write_documents(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    vocabulary_path: str | None = None,
    segment_tokens: int = 2_000_000,
) -> None:
    """Encode every text, append end_id, write segments in ascending id order (null ids first) to `path`.

    Null texts are empty: their only token is end_id. Rows with one id stand together, by their texts.
    An empty table writes a table without segments. Other columns are ignored.
    """
    ready(df)
    spark, where = df.sparkSession, vocabulary_path or vocabulary()
    docs = id_and_text(df, id_col, text_col)
    n = tasks(spark)
    docs = docs.withColumn("range", range_of(F.col("doc_id"), id_cuts(docs.select("doc_id"), 4 * n)))
    # The texts cross the network once; several ranges a task even out the dealing by hash.
    docs = docs.repartition(n, "range").sortWithinPartitions("range", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at, held = encoder(where), None, [[], [], []]

        def flush() -> pa.RecordBatch:
            ids, lens = np.concatenate(held[1]), np.concatenate(held[2])
            image = build(ids, held[0], np.concatenate([[0], np.cumsum(lens)]))
            row = [pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array([len(held[0])]), pa.array([len(ids)]), pa.array([image])]
            for x in held:
                x.clear()
            return pa.RecordBatch.from_arrays(row, ["range", "segment", "n_docs", "n_tokens", "image"])

        for batch in batches:
            for b in slices(batch, "text"):
                ids, first = enc.encode(b.column("text").cast(pa.string()), end_id)
                doc_ids, ranges = b.column("doc_id").to_pylist(), np.asarray(b.column("range"))
                i = 0
                while i < len(doc_ids):
                    if at is None or at[0] != ranges[i] or sum(map(len, held[1])) >= segment_tokens:
                        same = at is not None and at[0] == ranges[i]
                        if held[0]:
                            yield flush()
                        at = (int(ranges[i]), at[1] + 1 if same else 0)
                    room = segment_tokens - sum(map(len, held[1]))
                    j = max(int(np.searchsorted(first, first[i] + room, "right")) - 1, i + 1)
                    j = min(j, i + int(np.searchsorted(ranges[i:], ranges[i], "right")))
                    held[0] += doc_ids[i:j]
                    held[1].append(ids[first[i] : first[j]])
                    held[2].append(np.diff(first[i : j + 1]))
                    i = j
        if held[0]:
            yield flush()

    docs.mapInArrow(run, SEGMENT).write.mode("overwrite").parquet(path)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(range, segment, start): tokens of all documents before the segment. Two small running sums."""
    s = spark.read.parquet(path).select("range", "segment", "n_tokens")
    order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = s.groupBy("range").agg(F.sum("n_tokens").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    inside = Window.partitionBy("range").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return s.join(ranges, "range").select("range", "segment", (F.col("before") + F.col("within")).alias("start"))


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, read from the segments at `path`.

    start: tokens of all documents before it; ids_crc32: unsigned, of its ids as little-endian unsigned
    32-bit integers; ids: these bytes.
    """
    ready(spark.range(0))
    schema = "range int, segment int, doc_id long, first long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                s = Segment(b.column("image")[k].as_py())
                n, crc, ids = len(s.doc_ids), [], []
                for i in range(0, n, 1024):  # a run of documents is unpacked at once
                    j = min(i + 1024, n)
                    data = s.tokens(int(s.first[i]), int(s.first[j])).astype("<u4").tobytes()
                    cut = (s.first[i : j + 1] - s.first[i]) * 4
                    for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
                        crc.append(zlib.crc32(memoryview(data)[x:y]))
                        if with_ids:
                            ids.append(data[x:y])
                cols = [pa.array(np.full(n, b.column(c)[k].as_py(), np.int32)) for c in ("range", "segment")]
                cols += [pa.array(s.doc_ids, pa.int64()), pa.array(s.first[:-1]), pa.array(np.diff(s.first)), pa.array(crc, pa.int64())]
                names = ["range", "segment", "doc_id", "first", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(ids, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)

    docs = spark.read.parquet(path).select("range", "segment", "image").mapInArrow(run, schema)
    x = docs.join(segment_starts(spark, path), ["range", "segment"])
    return x.select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
