"""Exact line dedup with DataFrame functions only.

Lines are normalised and hashed; a hash found in ``min_docs`` documents or more loses its lines everywhere
but in the document with the largest id. The texts cross the network once, to meet the positions to drop;
lines themselves travel as (hash, id, row, position) only, written once and read for the counts and for the marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import WS_CHARS, lower_ascii

#: Repeated lines that are sent to all tasks (48 bytes each); beyond that the lines meet them by their key.
MAX_BROADCAST_LINES = 500_000
#: A key in more documents than this, and in more than a 100,000th of all that are counted, is dealt in parts.
PART_DOCS, MOST_HOT = 10_000, 100_000


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(WS_CHARS)))


def deduplicate_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    out: str = "_lines",
    max_broadcast: int = MAX_BROADCAST_LINES,
    part_docs: int = PART_DOCS,
) -> DataFrame:
    """df with a column `out`: struct(text, n_lines, n_dropped); every other column as it was.

    A null text is one empty line. A text that loses all its lines becomes empty; the row stays. Rows with
    the same id are one document, so a key is counted once for them and all of them keep it if their id is
    the largest. Rows with a null id are no document: they don't count, and lose the lines that are dropped.
    Ids may repeat: positions are joined on (id, hash of the text). An empty table stays empty. `out` must not be a
    column of df.
    """
    if out in df.columns:
        raise ValueError(f"the table has a column {out}; name another with out=")
    ident, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # The line array is made before the join, so it reaches the lambdas below as a plain column.
    docs = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col]).alias("row"),
        ident.alias("id"),
        F.xxhash64(text).alias("th"),
        F.split(text, "\n").alias("lines"),
    )
    keyed = df.select(ident.alias("id"), F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    keyed = keyed.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= min_chars)
    keyed = materialize(keyed.select("id", "th", "pos", F.unhex(F.md5("key")).alias("key")))
    # Two steps of partial sums: (key, id), then key; a key in a third of all documents is never one task's rows.
    once = keyed.filter("id is not null").groupBy("key", "id").agg(F.lit(1).alias("one"))
    many = once.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper")).filter(F.col("n") >= min_docs)
    many = materialize(many)
    lost = _meet(keyed, many, max_broadcast, part_docs).filter(~F.col("id").eqNullSafe(F.col("keeper")))
    lost = lost.groupBy("id", "th").agg(F.collect_set("pos").alias("lost")).withColumnsRenamed({"id": "lost_id", "th": "lost_th"})
    x = docs.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("th") == F.col("lost_th")), "left")
    n = F.size("lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("lost"))
    x = x.withColumn("kept", F.when(F.col("lost").isNotNull(), kept))
    joined = F.when(F.col("kept").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
    )
    done = F.struct(
        joined.alias("text"),
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    x = x.withColumn("done", done)
    return x.select(*[F.col(f"row.`{c}`") for c in df.columns if c != text_col], F.col("done").alias(out))


def _meet(keyed: DataFrame, many: DataFrame, max_broadcast: int, part_docs: int) -> DataFrame:
    """keyed with the repeated lines that they are (materialised: key, n, keeper)."""
    lines, docs = many.agg(F.count(F.lit(1)), F.sum("n")).first()
    if lines <= max_broadcast:
        return keyed.join(F.broadcast(many), "key")
    # Keys above this number are at most MOST_HOT, as their documents add up to docs.
    bound = max(part_docs, docs // MOST_HOT)
    parts = F.ceil(F.col("n") / bound).cast("int")
    hot = many.filter(F.col("n") > bound).select("key", parts.alias("parts"))
    keyed = keyed.join(F.broadcast(hot), "key", "left")
    keyed = keyed.withColumn("part", F.coalesce(F.pmod(F.xxhash64("id", "th", "pos"), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    copies = F.when(F.col("n") > bound, parts).otherwise(1)
    many = many.withColumn("part", F.explode(F.sequence(F.lit(0), copies - 1)))
    return keyed.join(many, ["key", "part"])
