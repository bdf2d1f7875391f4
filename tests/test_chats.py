"""Conversations from a stream of turns: parts, late turns, replayed batches, nulls, against a plain model."""

import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from quarry.plans import builders as B
from quarry.sources import fixtures as fx
from quarry.streaming import chats as C

TURNS = "id long, turn long, role string, content string, ts timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def land(spark, rows, folder):
    spark.createDataFrame(rows, TURNS).coalesce(1).write.mode("append").parquet(folder)


def log(spark, folder):
    return spark.readStream.schema(TURNS).parquet(folder)


def texts(df):
    return sorted(((r.id, [(m.role, m.content) for m in r.messages]) for r in df.collect()), key=str)


def test_parts_give_the_chats_of_the_whole_log(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None]), at(10 * c + t)) for c in range(12) for t in range(rng.randint(1, 9))]
    rows += [rows[5], rows[5], (None, 0, "user", "no id", at(40)), (None, 1, "assistant", "nor here", at(41)), (3, None, "user", "no turn", at(31))]
    whole = spark.createDataFrame(rows, TURNS).withColumnsRenamed({"id": "conv_id", "content": "text"})
    folder, path = tempfile.mkdtemp(), tempfile.mkdtemp()
    rows.sort(key=lambda r: r[4])
    third = len(rows) // 3
    for i, part in enumerate((rows[:third], rows[third : 2 * third], rows[2 * third :])):
        rng.shuffle(part)
        land(spark, part, folder)
        got = C.assemble(log(spark, folder), quiet="15 minutes", path=path, ended=i == 2)
        if i < 2:
            closed = {r.id for r in got.collect()}
            assert closed and rows[-1][0] not in closed  # some are closed on the way, not all
    turns = F.struct("turn", F.struct("role", F.col("text").alias("content")).alias("m"))
    want = whole.groupBy("conv_id").agg(F.sort_array(F.collect_list(turns)).alias("x"))
    want = want.select(F.col("conv_id").alias("id"), F.transform("x", lambda y: y["m"]).alias("messages"))
    assert texts(got) == texts(want)
    assert C.late_turns(spark, path).count() == 0
    again = C.assemble(log(spark, folder), quiet="15 minutes", path=path, ended=True)  # nothing new: nothing changes
    assert texts(again) == texts(want)


def test_late_turns_stand_beside_the_records(spark):
    folder, path = tempfile.mkdtemp(), tempfile.mkdtemp()
    land(spark, [(1, 0, "user", "q", at(0)), (1, 1, "assistant", "r", at(1)), (2, 0, "user", "open", at(100))], folder)
    assert texts(C.assemble(log(spark, folder), path=path)) == [(1, [("user", "q"), ("assistant", "r")])]
    # Conversation 1 is closed: its old turn is late, a turn of today begins it anew; conversation 2 is open: its old turn is its own.
    land(spark, [(1, 2, "user", "late", at(2)), (1, 3, "user", "anew", at(101)), (2, 1, "user", "old", at(5)), (3, 0, "user", "no time", None)], folder)
    got = C.assemble(log(spark, folder), path=path, ended=True)
    assert texts(got) == sorted([
        (1, [("user", "q"), ("assistant", "r")]), (1, [("user", "anew")]), (2, [("user", "open"), ("user", "old")]), (3, [("user", "no time")]),
    ], key=str)
    assert [tuple(r)[:4] for r in C.late_turns(spark, path).collect()] == [(1, 2, "user", "late")]


def test_a_batch_played_again_changes_nothing(spark):
    """The marks say which tables a batch starts from, so a table left by an attempt that failed is not read."""
    folder, path = tempfile.mkdtemp(), tempfile.mkdtemp()
    land(spark, [(1, 0, "user", "q", at(0)), (2, 0, "user", "x", at(100))], folder)
    C.assemble(log(spark, folder), path=path)
    # What an attempt of the next batch left before it failed: a table of open conversations and records, without a mark.
    schema = C.open_schema(spark.createDataFrame([], TURNS).schema)
    spark.createDataFrame([(9, [(0, "user", "left over", at(0))])], schema).write.parquet(f"{path}/open/batch=1")
    C.conversations(spark.createDataFrame([(9, [(0, "user", "left over", at(0))])], schema)).write.parquet(f"{path}/data/batch=1")
    land(spark, [(2, 1, "assistant", "y", at(101))], folder)
    got = C.assemble(log(spark, folder), path=path, ended=True)
    assert texts(got) == [(1, [("user", "q")]), (2, [("user", "x"), ("assistant", "y")])]


def test_nothing_landed_and_nothing_open(spark):
    folder, path = tempfile.mkdtemp(), tempfile.mkdtemp()
    land(spark, [], folder)
    builder = lambda chats: B.static_reviewer(chats, keywords=["a"])
    assert C.assemble(log(spark, folder), builder, path=path, ended=True).collect() == []
    land(spark, [(1, 0, "user", "a", at(0)), (1, 1, "assistant", "b", at(0))], folder)
    assert C.assemble(log(spark, folder), builder, path=path).collect() == []
    assert [r.id for r in C.assemble(log(spark, folder), builder, path=path, ended=True).collect()] == [1]


def test_a_conversation_with_a_third_of_the_log_is_one_record(spark):
    folder = tempfile.mkdtemp()
    rows = [(0, t, "user", str(t), at(t / 60)) for t in range(3000)] + [(c, 0, "user", "x", at(c / 100)) for c in range(1, 6000)]
    land(spark, rows, folder)
    got = {r.id: r.n for r in C.assemble(log(spark, folder), ended=True).select("id", F.size("messages").alias("n")).collect()}
    assert len(got) == 6000 and got[0] == 3000 and sum(got.values()) == len(rows)


def test_turn_times_follow_the_turns(spark):
    rows = [(1, 0, "user", "x"), (1, 5, "assistant", "y"), (None, None, None, None)]
    log_ = fx.chat_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [r.ts for r in log_.collect()] == [dt.datetime(1970, 1, 1, 0, 1), dt.datetime(1970, 1, 1, 0, 1, 5), dt.datetime(1970, 1, 1)]
