"""Rows that used to be lost or taken wrongly: null groups, long samples, many groups, encoders, roles, broken lines."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.arrays import cap_tests, coerce_tests
from quarry.operators import monitor, order, pack, recipes, tokenize
from quarry.sources import jsonl
from quarry.streaming import monitors


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, k long")
    assert order.global_rank(df, "k", partition_by=["g"]).count() == 3
    assert order.sample_n(df, "k", 2, partition_by=["g"]).count() == 3
    assert order.split(df, "k", 0.5, partition_by=["g"]).count() == 3
    assert order.ordinal_rank(df, ["g"], ["k"]).count() == 3
    with pytest.raises(ValueError, match="bucket_hex"):
        order.global_rank(df, "k", bucket_hex=6)


def test_null_runs_keep_their_rows(spark):
    rows = [(None, 1, 1.0), (None, 2, 2.0), (7, 1, 1.0)]
    m = spark.createDataFrame(rows, "run long, step long, eval_loss double").withColumn("ts", F.timestamp_seconds("step"))
    assert monitor.divergence(m).count() == 3 and monitor.cost_meter(m).count() == 3


def blocks_of(samples, L, eos):
    buf, out = [], []
    for s in samples:
        buf += ([eos] if buf else []) + s
        while len(buf) >= L:
            out.append(buf[:L])
            buf = buf[L:]
    return out


def test_samples_longer_than_a_block_and_many_groups(spark):
    rng = np.random.default_rng(2)
    rows = [(g, k, rng.integers(1, 99, n).tolist()) for g in (None, "a", "b", "c") for k, n in enumerate([20, 0, 3, 8, 17, 1])]
    df = spark.createDataFrame(rows, "g string, k long, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    got = pack.pack(df, "k", 8, eos_id=0, partition_by=["g"], chunk_rows=2, fanout=2)
    rank = {(r.g, r.k): r["rank"] for r in order.global_rank(df, "k", partition_by=["g"]).collect()}
    for g in (None, "a", "b", "c"):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: rank[g, r[1]])
        have = [r.input_ids for r in sorted((r for r in got.collect() if r.g == g), key=lambda r: r.block_id)]
        assert have == blocks_of([r[2] for r in mine], 8, 0)


def test_repeated_keys_are_an_error(spark):
    df = spark.createDataFrame([(1, [1, 2]), (1, [3, 4])], "k long, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    with pytest.raises(ValueError, match="unique"):
        pack.pack(df, "k", 4)


def test_each_encoder_is_its_own(spark):
    df = spark.createDataFrame([(1, "abc")], "id long, text string")
    for n in range(8):
        def factory(n=n):
            return lambda texts: [[n] * len(t) for t in texts]

        assert tokenize.encode_with(df, factory).first().input_ids == [n] * 3


def test_byte_ids(spark):
    df = spark.createDataFrame([(1, "aé😀"), (2, ""), (3, None), (4, "x" * 50)], "id long, text string").repartition(1)
    got = {r.id: r.input_ids for r in tokenize.byte_encode(df, "text", 10).collect()}
    assert got == {1: list("aé😀".encode()), 2: [], 3: [], 4: [120] * 10}


def test_new_role_renamed_chat_column_and_unknown_role(spark):
    over = {"poet": {"format": "chat", "fields": {"messages": "talk"}}}
    table = recipes.recipes(spark, over)
    talk = T.ArrayType(jsonl.MESSAGE)
    df = spark.createDataFrame([("poet", [("user", "hi")])], T.StructType([T.StructField("role", T.StringType()), T.StructField("talk", talk)]))
    assert recipes.render_by_recipe(recipes.with_recipe(df, table)).first().text == "<|user|>\nhi"
    bad = spark.createDataFrame([("nobody",)], "role string")
    for c in ("format", "fields", "max_seq_length", "packing"):
        with pytest.raises(Exception, match="nobody"):
            recipes.with_recipe(bad, table).select(c).collect()


def test_unit_tests_as_json_text(spark):
    df = spark.createDataFrame([('[" a ", {"code": "b"}, null, ""]',)], "t string")
    assert df.select(cap_tests(coerce_tests("t", T.StringType())).alias("x")).first().x == ["a", "b", "None"]


def test_broken_lines_fail_and_sinks_are_read_back(spark, tmp_path):
    rec = spark.createDataFrame([("a", "b", "c")], "instruction string, input string, output string")
    jsonl.write_jsonl(rec, str(tmp_path / "out"))
    assert [tuple(r) for r in jsonl.read_cached_dir(spark, str(tmp_path / "out")).collect()] == [("a", "b", "c")]
    for k, line in enumerate(['{"instruction":"a"} x', "{'instruction':'a'}", "[1]"]):
        (tmp_path / f"{k}.jsonl").write_text(line + "\n")
        with pytest.raises(Exception, match="no JSON object"):
            jsonl.read_jsonl(spark, str(tmp_path / f"{k}.jsonl")).collect()


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    src, out = str(tmp_path / "log"), str(tmp_path / "run")
    rows = spark.range(40).select((F.col("id") % 3).alias("run"), F.expr("timestamp'2024-01-01' + make_interval(0,0,0,0,0,id)").cast("timestamp_ntz").alias("ts"))
    rows.filter("ts < '2024-01-01 00:20:00'").repartition(3).write.parquet(src)
    first = monitors.run_available(monitors.cost_stream(monitors.metrics_stream(spark, src, rows.schema, 1)), "cost", spark, out).count()
    rows.filter("ts >= '2024-01-01 00:20:00'").write.mode("append").parquet(src)
    again = monitors.run_available(monitors.cost_stream(monitors.metrics_stream(spark, src, rows.schema, 1)), "cost", spark, out)
    assert first == 20 and again.count() == 40 and again.select("run", "step").distinct().count() == 40
