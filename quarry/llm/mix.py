"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

Targets: the sources share the corpus' words by weight; a source stops at ``most`` times its words and the
excess is shared again by weight among the others. Taken words: a source's documents are walked in a
seeded md5 order, pass after pass, until the target word; the document at the target is cut there, so a
source misses its target by less than one word.

Positions: a source's weight may change over training time t in [0, 1]. Its schedule is a line through
``(start, end)`` relative weights; its integral is the source's cumulative word demand. A document's
copy that begins at word c of its source gets the time at which the demand reaches c (the integral
inverted), and the mix is range-sorted by that time. Time-varying weights change the order, not the totals.

Sums over a source are never one task's work: documents are dealt to hash buckets, partial sums per
(source, bucket) are accumulated over the bounded bucket table, and running sums stay within a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WS_CLASS

#: Start and end weight of each weight class relative to its mean of 1: rare classes early, heavy ones late.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def word_count(text: Column) -> Column:
    """Number of runs of other characters than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WS_CLASS.replace("[", "[^") + "+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, class, target) of a (source, source_size) table.

    Sources by code point, null last, weigh weights[0], weights[1], ..., repeating; class is that index.
    Sharing the excess until none is above its stop ends at one level L: target = min(most * size, L * weight).
    Sources sorted by the level at which they stop give L from two running sums. The table has a row per
    source, not per document.
    """
    k = len(weights)
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), F.col("class") + 1)
    s = sizes.withColumn("rank", rank).withColumn("class", F.col("rank") % k)
    s = s.withColumn("w", w).withColumn("stop", F.lit(most) * F.col("source_size"))
    order = Window.orderBy(F.col("stop") / F.col("w"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0)))
    s = s.withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    # Met in the order in which they stop, a source stops if its share of what is left reaches its stop.
    s = s.withColumn("level", F.col("left").cast("double") / F.col("w_left").cast("double"))
    s = s.withColumn("stops", F.min(F.when(F.col("level") * F.col("w") >= F.col("stop"), 1).otherwise(0)).over(so_far))
    s = s.withColumn("turn", F.row_number().over(order))
    share = F.min(F.when(F.col("stops") == 0, F.struct("turn", "level"))).over(everything)
    s = s.withColumn("share", share)
    target = F.when(F.col("stops") == 1, F.col("stop").cast("double")).otherwise(F.col("share.level") * F.col("w"))
    return s.select("source", "source_size", "class", target.alias("target"))


def _time_of(x: Column, schedule: Column) -> Column:
    """t with integral 0..t of the line start -> end (mean 1) equal to x, both in [0, 1]."""
    a, b = schedule["start"], schedule["end"]
    return F.lit(2.0) * x / (a + F.sqrt(a * a + F.lit(2.0) * (b - a) * x))


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: int = 42,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    bucket_hex: int = 3,
) -> DataFrame:
    """(doc_id, th, size, source_size, target, taken, first_word, position), one row per row of df.

    th: xxhash64 of the text (tells rows with one id apart). taken: words of the document that the mix
    takes, whole passes and at most one cut one; 0 where the source's target ends before it. first_word:
    the source's words before the document within a pass; position: training time of its first copy, null
    if none is taken. Null texts have size 0, null sources are one source, the last; null ids are ordered
    as the word null. Rows equal in id and size may trade places, which changes no total and no set of
    results. An empty table gives an empty result.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))))
    docs = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.xxhash64(F.col(f"`{text_col}`").cast("string")), F.lit(0)).alias("th"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        word_count(F.col(f"`{text_col}`").cast("string")).alias("size"),
        key.alias("key"),
    ).withColumn("bucket", F.substring("key", 1, bucket_hex))
    docs = materialize(docs)
    buckets = materialize(docs.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    targets = materialize(source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    of_bucket = buckets.withColumnRenamed("source", "s").join(targets, F.col("s").eqNullSafe(F.col("source"))).drop("s", "words")
    of_bucket = of_bucket.withColumnsRenamed({"source": "s", "bucket": "b"})
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "th").rowsBetween(Window.unboundedPreceding, -1)
    x = docs.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    x = x.join(of_bucket, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    x = x.withColumn("first_word", F.col("before") + F.col("within")).withColumn("goal", F.round("target").cast("long"))
    size, total = F.col("size"), F.col("source_size")
    x = x.withColumn("passes", F.when(total > 0, F.floor(F.col("goal") / total)).otherwise(0).cast("long"))
    rest = F.col("goal") - F.col("passes") * total - F.col("first_word")
    taken = F.col("passes") * size + F.greatest(F.lit(0), F.least(size, rest))
    sched = F.element_at(F.array(*[F.struct(F.lit(float(a)).alias("start"), F.lit(float(b)).alias("end")) for a, b in schedules]), F.col("class") % len(schedules) + 1)
    x = x.withColumn("taken", taken.cast("long")).withColumn("sched", sched)
    return x.select(
        "doc_id", "th", "size", "source_size", "target", "taken", "first_word",
        F.when(F.col("taken") > 0, _time_of(F.col("first_word") / F.col("goal"), F.col("sched"))).alias("position"),
        "passes", "goal", "sched", "source",
    )


def range_sorted(df: DataFrame, *by: str) -> DataFrame:
    """Sorted by ranges of training time; no single task holds the order."""
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: df's columns, a row per copy taken, range-sorted by training time.

    A document of which 2.4 times its words are taken gives two rows with its text and one with its first
    words, joined by one space; a document of which nothing is taken gives none. Equal rows (id, source and
    text) are numbered so that each gives its own share.
    """

    def keyed(x: DataFrame, id_: str, source: str) -> DataFrame:
        known = lambda c: F.when(c.isNull(), "-").otherwise(F.concat(F.lit("+"), c.cast("string")))
        return x.withColumn("k_id", known(F.col(id_))).withColumn("k_source", known(F.col(source)))

    text, keys = F.col(f"`{text_col}`").cast("string"), ["k_id", "k_source", "th"]
    m = keyed(mix(df, id_col, text_col, source_col, **options), "doc_id", "source")
    m = m.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("first_word")))
    m = materialize(m.select(*keys, "n", "size", "taken", "passes", "first_word", "source_size", "goal", "sched"))
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), text.alias("text"),
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("th"),
    )
    rows = keyed(rows, "id", "source").drop("id", "source")
    if m.filter("n > 1").take(1):
        rows, keys = rows.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("k_id"))), [*keys, "n"]
    x = rows.join(m.filter("taken > 0"), keys)
    cut = F.col("taken") - F.col("passes") * F.col("size")
    copies = F.sequence(F.lit(0), F.col("passes") - F.when(cut > 0, 0).otherwise(1))
    x = x.withColumn("cut", cut).withColumn("pass", F.explode(copies))
    at = (F.col("pass") * F.col("source_size") + F.col("first_word")) / F.col("goal")
    words = F.filter(F.split("text", WS_CLASS + "+"), lambda w: w != "")
    first = F.array_join(F.slice(words, 1, F.col("cut").cast("int")), " ")
    shown = F.when((F.col("pass") < F.col("passes")) | (F.col("cut") >= F.col("size")), F.col("text")).otherwise(first)
    out = [(shown if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in df.columns]
    x = x.select(F.struct(*out).alias("row"), _time_of(at, F.col("sched")).alias("position"), "k_id")
    return range_sorted(x, "position", "k_id").select("row.*")
