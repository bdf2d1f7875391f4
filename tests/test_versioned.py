"""Files taken once, in their latest version, by batch and stream runs; rejects; splits as a column; roles together."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import order, pack
from quarry.plans import builders as B
from quarry.sources import jsonl, tables, versioned

SCHEMA = "k long, v string"


def put(folder, name, *lines):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("".join(f"{x}\n" for x in lines))
    os.utime(path, (time.time(), os.path.getmtime(path) + 2 * len(lines)))


def rows(spark, root):
    return sorted((r.k, r.v) for r in versioned.read_folder(spark, root, SCHEMA).collect())


def test_a_changed_file_gives_its_new_rows_only(spark):
    src, root = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="root-") + "/t"
    put(src, "a.jsonl", '{"k": 1, "v": "old"}', '{"k": 2, "v": "old"}')
    put(src, "sub dir/ä+%.jsonl", '{"k": 3, "v": "kept"}')
    assert versioned.ingest_folder(spark, src, root, SCHEMA) == 2
    assert versioned.ingest_folder(spark, src, root, SCHEMA) == 0
    put(src, "a.jsonl", '{"k": 1, "v": "new"}')
    put(src, "b.jsonl", '{"k": 4, "v": "b"}')
    assert versioned.ingest_folder(spark, src, root, SCHEMA) == 2
    assert rows(spark, root) == [(1, "new"), (3, "kept"), (4, "b")]
    assert versioned.latest(versioned.manifest(spark, root)).count() == 3
    assert versioned.manifest(spark, root).count() == 4  # the superseded version stays on record


def test_batch_and_stream_runs_take_each_file_once(spark):
    src, root = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="root-") + "/t"
    point = tempfile.mkdtemp(prefix="ckpt-")
    put(src, "a.jsonl", '{"k": 1, "v": "a"}')
    versioned.ingest_folder(spark, src, root, SCHEMA)
    put(src, "b.jsonl", '{"k": 2, "v": "b"}')
    versioned.stream_folder(spark, src, root, SCHEMA, point)  # meets a.jsonl too
    put(src, "c.jsonl", '{"k": 3, "v": "c"}')
    versioned.ingest_folder(spark, src, root, SCHEMA)
    versioned.stream_folder(spark, src, root, SCHEMA, point)
    assert rows(spark, root) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_replayed_batch_replaces_itself(spark):
    src, root = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="root-") + "/t"
    put(src, "a.jsonl", '{"k": 1, "v": "a"}')
    batch = versioned.with_file(spark.read.schema(SCHEMA).json(src))
    versioned.take_batch(batch, 0, root, "s")
    put(src, "b.jsonl", '{"k": 2, "v": "b"}')
    versioned.ingest_folder(spark, src, root, SCHEMA)
    before = sorted(map(str, versioned.manifest(spark, root).collect()))
    versioned.take_batch(batch, 0, root, "s")
    assert rows(spark, root) == [(1, "a"), (2, "b")]
    assert sorted(map(str, versioned.manifest(spark, root).collect())) == before
    # Rows whose commit did not come to its manifest are not seen.
    batch.drop("_length", "_time").write.parquet(f"{root}/data/batch=lost")
    assert rows(spark, root) == [(1, "a"), (2, "b")]


def test_nothing_was_taken(spark):
    assert versioned.read_folder(spark, tempfile.mkdtemp(prefix="root-") + "/t", SCHEMA).count() == 0


def test_bad_lines_cost_themselves_only(spark):
    src, root = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="root-") + "/t"
    put(src, "a.jsonl", '{"k": 1, "v": "é"}', "", '{"k": 2', "[1]", '{"v": "no k"}', "{'k': 3}", '{"k": 4, "v": null} ', '{"k": 1} x')
    put(src, "b.jsonl", "not json")
    good, bad, counts = jsonl.split_jsonl(spark, src, root, T.StructType.fromDDL(SCHEMA), ["k"])
    assert sorted((r.line, r.k, r.v) for r in good.collect()) == [(1, 1, "é"), (7, 4, None)]
    got = sorted((r.file[-7:], r.line, r.issue, r.value) for r in bad.collect())
    assert [(f, n, i) for f, n, i, _ in got] == [
        ("a.jsonl", 3, "invalid_json"), ("a.jsonl", 4, "not_object"), ("a.jsonl", 5, "missing_fields"), ("a.jsonl", 6, "invalid_json"),
        ("a.jsonl", 8, "invalid_json"), ("b.jsonl", 1, "invalid_json"),
    ]
    assert got[0][3] == '{"k": 2' and counts == {"records": 2, "rejects": 6}


def test_only_bad_lines(spark):
    src, root = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="root-") + "/t"
    put(src, "a.jsonl", "x")
    good, bad, counts = jsonl.split_jsonl(spark, src, root, T.StructType.fromDDL(SCHEMA))
    assert (good.count(), bad.count(), counts) == (0, 1, {"records": 0, "rejects": 1})


def test_split_column_prunes_folders(spark):
    root = tempfile.mkdtemp(prefix="splits-") + "/t"
    spark.range(10).withColumn("split", F.when(F.col("id") < 3, "test").otherwise("train")).write.partitionBy("split").parquet(root)
    got = tables.read_source(spark, root, "test", split_column="split")
    assert got.columns == ["id"] and got.count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(FileNotFoundError, match="split=none"):
        tables.read_first_available(spark, [(root, "none", "parquet", "split"), (root, "x", "parquet", "no_such_column")])


def blocks_of(samples, L):
    buf, out = [], []
    for s in samples:
        buf += ([0] if buf else []) + s
        while len(buf) >= L:
            out.append(buf[:L])
            buf = buf[L:]
    return out


def test_each_group_has_its_block_length(spark):
    lengths = {"a": 4, "b": 7, None: 5}
    data = [(g, L, k, [k + 1] * (3 * k % 11)) for g, L in lengths.items() for k in range(9)]
    df = spark.createDataFrame(data, "g string, block int, k long, input_ids array<int>")
    for options in ({}, {"chunk_rows": 2, "fanout": 2}):
        got = pack.pack(df, "k", "block", partition_by=["g"], **options).collect()
        for g, L in lengths.items():
            rank = {r.k: r["rank"] for r in order.global_rank(df.filter(F.col("g").eqNullSafe(F.lit(g))), "k").collect()}
            samples = [ids for _, _, k, ids in sorted((r for r in data if r[0] == g), key=lambda r: rank[r[2]])]
            mine = sorted((r for r in got if r.g == g), key=lambda r: r.block_id)
            assert [r.input_ids for r in mine] == blocks_of(samples, L) and all(r.block == L for r in mine)


def test_roles_are_written_by_one_job(spark):
    root = tempfile.mkdtemp(prefix="roles-")
    src = spark.createDataFrame([(i, f"ask {i}", None, "answer " * 5) for i in range(6)], "id long, instruction string, input string, output string")
    chats = spark.createDataFrame([(1, [("user", "def x"), ("assistant", "yes")])], "id long, messages array<struct<role:string,content:string>>")
    status = B.write_together({"code_writer": src, "static_reviewer": chats}, root, ["code_writer", "static_reviewer", "docs_generator"])
    assert [(r, n) for r, n, _ in status] == [("code_writer", 6), ("static_reviewer", 1), ("docs_generator", None)] and status[2][2]
    lines = [r.value for r in spark.read.text(f"{root}/role=code_writer").collect()]
    assert len(lines) == 6 and all('"input":""' in x and "messages" not in x for x in lines)
    assert jsonl.read_jsonl(spark, f"{root}/role=static_reviewer", jsonl.CHAT_SCHEMA).first().messages[0].content == "def x"
    assert B.write_together({}, root, ["code_writer"])[0][1] is None
