"""Vocabulary tables and the encoder that uses them.

A vocabulary is a table (token, count, id): the words of a text column with how often they stand there, numbered from
the most frequent one. Counts are summed on the map side first, and the numbers come from ``order.ordinal_rank``, so no
window runs over all words in one task.

The encoder deals documents to slices of about ``SLICE_BYTES`` of text by their key. A slice's different words get their
ids by a join, each once a slice however often it stands there, and meet the slice's documents in one Arrow call, which
looks the words up in order. So a text moves as it is, not as a row a word, and nothing is collected or sorted a word.
A document travels as strings of ``piece_words`` words. A vocabulary under a counted bound is broadcast, and the words stay
where their slice is. Beyond it the words meet it by a shuffle, in which a word of every slice would still be a row a slice
in one task; words that fill much of the text are at most ``HOT_SHARE`` by their counts and are broadcast, and a word that
has its id already travels under a key of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .order import check_unique, ordinal_rank
from .tokenize import IDS, with_encoding

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
MAX_BROADCAST_WORDS = 1_000_000
#: Words that make up more than this part of the text (1 / HOT_SHARE) are hot: at most HOT_SHARE of them exist.
HOT_SHARE = 10_000
#: Text of a slice of documents, whose words are looked up together.
SLICE_BYTES = 4_000_000
UNKNOWN_ID = 0


def words(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(WORD), 0)


def build_vocabulary(
    df: DataFrame, text: str = "text", min_count: int = 1, max_size: int | None = None, first_id: int = 1
) -> DataFrame:
    """(token, count, id) of the words that stand in the column at least ``min_count`` times.

    Ids go up from ``first_id`` by falling count, equal counts by the word; with ``max_size`` only so many stay. Null texts
    have no words; an empty table gives an empty vocabulary."""
    counts = df.select(F.explode(words(text)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    counts = counts.filter(F.col("count") >= int(min_count))
    ranked = ordinal_rank(counts.withColumn("_less", -F.col("count")), [], ["_less", "token"], out="_rank")
    if max_size is not None:
        ranked = ranked.filter(F.col("_rank") <= int(max_size))
    return ranked.select("token", "count", (F.col("_rank") + int(first_id) - 1).alias("id"))


def _with_ids(x: DataFrame, vocabulary: DataFrame, spread: Column, max_broadcast: int) -> DataFrame:
    """x (…, token) with the id of its token, null where it has none."""
    size, total = vocabulary.agg(F.count(F.lit(1)), F.sum("count")).first()
    side = vocabulary.select(F.col("token").alias("_token"), F.col("id").alias("_id"))
    if size <= max_broadcast:
        return x.join(F.broadcast(side), F.col("token") == F.col("_token"), "left").drop("_token")
    is_hot = F.col("count") > (total or 0) // HOT_SHARE
    hot = vocabulary.filter(is_hot).select(F.col("token").alias("_hot"), F.col("id").alias("_hot_id"))
    x = x.join(F.broadcast(hot), F.col("token") == F.col("_hot"), "left")
    # No word begins with a space, so such a key meets nothing and spreads the rows that need nothing.
    key = F.when(F.col("_hot_id").isNull(), F.col("token")).otherwise(F.concat(F.lit(" "), spread.cast("string")))
    cold = vocabulary.filter(~is_hot).select(F.col("token").alias("_token"), F.col("id").alias("_cold_id"))
    x = x.withColumn("_key", key).join(cold, F.col("_key") == F.col("_token"), "left")
    return x.withColumn("_id", F.coalesce("_hot_id", "_cold_id")).drop("_hot", "_hot_id", "_key", "_token", "_cold_id")


def encode_words(
    df: DataFrame,
    vocabulary: DataFrame,
    key,
    text: str = "text",
    max_len: int | None = None,
    unknown_id: int = UNKNOWN_ID,
    max_broadcast: int = MAX_BROADCAST_WORDS,
    piece_words: int = 8192,
) -> DataFrame:
    """(key…, input_ids, attention_mask, labels): the ids of a text's words in order, cut to ``max_len`` in the end.

    Words outside the vocabulary have ``unknown_id``. A text that is null or has no word has no ids. ``key`` must be
    unique and is checked. The vocabulary should be a stored table: it is read for its size and for the join."""
    keys = [key] if isinstance(key, str) else list(key)
    names = [f"_key{i}" for i in range(len(keys))]
    x = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], F.col(f"`{text}`").cast("string").alias("_text"))
    check_unique(x.select(*names), names, "encoding")
    size = x.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    dealt = F.pmod(F.xxhash64(*names), F.lit(size // SLICE_BYTES + 1)).alias("_slice")
    # A slice lies in one partition, so its words are made different before they move.
    found = x.select(dealt, "_text").repartition("_slice").select("_slice", F.explode(words("_text")).alias("token")).distinct()
    found = _with_ids(found, vocabulary, F.xxhash64("_slice", "token"), max_broadcast)
    found = found.filter(F.col("_id").isNotNull()).select("_slice", "token", F.col("_id").cast("int").alias("_id"))
    whole = x.select(*names, dealt, words("_text").alias("_words"))
    first = F.sequence(F.lit(1), F.size("_words"), F.lit(int(piece_words)))
    pieces = F.transform(first, lambda i: F.array_join(F.slice("_words", i, int(piece_words)), " "))
    whole = whole.select(*names, "_slice", F.when(F.size("_words") > 0, pieces).alias("_pieces"))
    schema = T.StructType([*[whole.schema[n] for n in names], T.StructField("_ids", IDS)])
    ship_package(df.sparkSession)
    ids = whole.groupBy("_slice").cogroup(found.groupBy("_slice")).applyInArrow(_slice_encoder(names, int(unknown_id)), schema)
    out = ids.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "_ids")
    return with_encoding(out, "_ids", 2**31 - 1 if max_len is None else int(max_len)).drop("_ids")


def _slice_encoder(names: Sequence[str], unknown_id: int):
    """Arrow function (documents of a slice as pieces, ids of its words) → (key…, _ids)."""

    def counted(lists) -> np.ndarray:
        """Lengths of lists, null ones empty."""
        return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def edges(counts: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(counts)])

    def encode(docs: pa.Table, ids: pa.Table) -> pa.Table:
        pieces = docs.column("_pieces").combine_chunks()
        split = pc.split_pattern(pieces.flatten(), " ")
        found = pc.index_in(split.flatten(), value_set=ids.column("token").combine_chunks())
        known = pc.take(ids.column("_id").combine_chunks(), found)
        values = pc.fill_null(known, unknown_id)
        # Edges of documents in words: their edges in pieces, then the pieces' edges in words.
        at = edges(counted(split))[edges(counted(pieces))]
        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)
        return pa.table([*[docs.column(n) for n in names], lists], names=[*names, "_ids"])

    return encode
