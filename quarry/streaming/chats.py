"""Conversations assembled from a stream of turns, for builders that need whole chats.

A record of a chat builder is a conversation, while a log brings its turns one by one. Turns are held by conversation in a
table of open conversations between micro-batches; one that had no turn for ``quiet`` before the newest turn is closed,
goes through the builder and is written. Per batch n, under the caller's path:

* ``data/batch=<n>`` the records of the conversations that closed in it,
* ``late/batch=<n>`` turns older than what was closed before, of conversations that are not open: kept whole beside the
  records, never dropped,
* ``open/batch=<n>`` the open conversations after it, and ``mark/batch=<n>`` the time up to which all is closed.

Batch n reads the tables that the batch before it left and replaces its own, so a batch that is played again after a
failure changes nothing. ``mark`` is written last: a batch without it counts as not done. A batch costs one shuffle of its
turns with those still open, whatever was closed before. A conversation is one record, so its turns meet in one row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_path

TURN = ("turn", "role", "content", "ts")
MARK = "cut timestamp_ntz, batch long"
LATE, CLOSES = "_late", "_closes"


def open_schema(turns: T.StructType) -> T.StructType:
    """Schema of the table of open conversations, from that of the turns (id, turn, role, content, ts)."""
    turn = T.StructType([T.StructField(c, turns[c].dataType) for c in TURN])
    return T.StructType([T.StructField("id", turns["id"].dataType), T.StructField("turns", T.ArrayType(turn))])


def conversations(held: DataFrame) -> DataFrame:
    """(id, messages) of (id, turns): turns by number, null ones first, equal ones by role and content."""
    message = F.transform(F.sort_array("turns"), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return held.select("id", message.alias("messages"))


def turn_batch(batch: DataFrame, held: DataFrame, cut: dt.datetime | None, quiet: str) -> tuple[DataFrame, dt.datetime | None]:
    """((id, turns, late turns, whether it closes) of the batch with what was open, the time up to which all is closed).

    Rows with a null id are one conversation. A turn without a time is never late and does not keep its conversation open;
    where no turn has a time, it stays open."""
    newest = batch.agg((F.max("ts") - F.expr(f"interval {quiet}")).alias("cut")).first()[0]
    after = max((x for x in (cut, newest) if x is not None), default=None)
    turns = batch.select("id", F.array(F.struct(*TURN)).alias("turns"), F.lit(False).alias("_held"))
    x = held.select("id", "turns", F.lit(True).alias("_held")).unionByName(turns)
    x = x.groupBy("id").agg(F.flatten(F.collect_list("turns")).alias("turns"), F.max("_held").alias("_held"))

    def late(t):
        return F.lit(False) if cut is None else F.coalesce(t["ts"] < F.lit(cut).cast("timestamp_ntz"), F.lit(False))

    x = x.select(
        "id",
        F.when(F.col("_held"), F.col("turns")).otherwise(F.filter("turns", lambda t: ~late(t))).alias("turns"),
        F.when(~F.col("_held"), F.filter("turns", late)).alias(LATE),
    )
    last = F.array_max(F.transform("turns", lambda t: t["ts"]))
    closes = F.lit(False) if after is None else F.coalesce(last < F.lit(after).cast("timestamp_ntz"), F.lit(False))
    return x.withColumn(CLOSES, closes), after


def _done(spark: SparkSession, base: str, before: int | None = None) -> tuple[int, dt.datetime | None]:
    """(number, cut) of the last batch that is done, -1 where none is."""
    marks = spark.read.schema(MARK).parquet(f"{base}/mark")
    marks = marks if before is None else marks.filter(F.col("batch") < before)
    last = marks.agg(F.max_by(F.struct("batch", "cut"), "batch").alias("m")).first()[0]
    return last["batch"], last["cut"]


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a table that no later batch reads; the file system is that of the path."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def assemble(
    turns: DataFrame,
    builder: Callable[[DataFrame], DataFrame] = lambda chats: chats,
    quiet: str = "1 hour",
    path: str | None = None,
    ended: bool = False,
) -> DataFrame:
    """``builder`` over the conversations of a stream of turns (id, turn, role, content, ts); the records so far.

    ``builder`` takes (id, messages), as the chat builders do. A call with the same ``path`` goes on where the last one
    ended. ``ended`` says that the log has ended: the records of what is still open come too, without being closed. A
    conversation that goes on after it was closed, with turns that are not late, is a conversation of its own."""
    spark = turns.sparkSession
    base = path or scratch_path(spark, "chats")
    src = turns.select("id", "turn", "role", "content", F.col("ts").cast("timestamp_ntz").alias("ts"))
    schema = open_schema(src.schema)
    none = spark.createDataFrame([], schema)
    builder(conversations(none)).write.mode("ignore").parquet(f"{base}/data/batch=-1")
    spark.createDataFrame([], src.schema).write.mode("ignore").parquet(f"{base}/late/batch=-1")
    none.write.mode("ignore").parquet(f"{base}/open/batch=-1")
    spark.createDataFrame([(None,)], "cut timestamp_ntz").write.mode("ignore").parquet(f"{base}/mark/batch=-1")

    def take(batch: DataFrame, n: int) -> None:
        last, cut = _done(spark, base, n)
        held = spark.read.schema(schema).parquet(f"{base}/open/batch={last}")
        x, after = turn_batch(batch, held, cut, quiet)
        x = materialize(x)
        builder(conversations(x.filter(CLOSES))).write.mode("overwrite").parquet(f"{base}/data/batch={n}")
        x.select("id", F.inline(LATE)).write.mode("overwrite").parquet(f"{base}/late/batch={n}")
        x.filter(~F.col(CLOSES) & (F.size("turns") > 0)).select("id", "turns").write.mode("overwrite").parquet(f"{base}/open/batch={n}")
        spark.createDataFrame([(after,)], "cut timestamp_ntz").write.mode("overwrite").parquet(f"{base}/mark/batch={n}")
        if 0 <= last - 1:
            _remove(spark, f"{base}/open/batch={last - 1}")  # the batch before this one is done: it is not played again

    query = src.writeStream.option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).foreachBatch(take).start()
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    records = spark.read.parquet(f"{base}/data").drop("batch")
    if not ended:
        return records
    still = spark.read.schema(schema).parquet(f"{base}/open/batch={_done(spark, base)[0]}")
    return records.unionByName(builder(conversations(still)))


def late_turns(spark: SparkSession, path: str) -> DataFrame:
    """The turns that came too late for their conversation, in whatever batch."""
    return spark.read.parquet(f"{path}/late").drop("batch")
