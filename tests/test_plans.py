"""Plan-shape checks: stages, pruning, Python stages, partitioning."""

import re

from pyspark.sql import functions as F

from quarry.operators import integrity as V
from quarry.operators import order
from quarry.operators.pack import pack
from quarry.plans import builders as B
from quarry.sources import fixtures as fx

from .conftest import SF001


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan_columns(df) -> set:
    cols = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", physical(df))
    return {re.sub(r"#\d+L?", "", c) for group in cols for c in group.split(",")}


def test_builders_are_single_stage_with_pruned_scans(spark):
    docs = fx.table(spark, SF001, "documents")
    cases = [
        (B.code_writer(fx.instructions(docs)), {"doc_id", "text", "source"}),
        (B.test_generator(fx.unit_tests(docs)), {"doc_id", "text"}),
        (B.security_auditor(fx.security_pairs(docs), langs=("en",)), {"doc_id", "text", "lang", "source"}),
        (B.docs_generator(fx.functions(docs)), {"doc_id", "text", "lang", "n_chars"}),
    ]
    for recs, expected in cases:
        assert "Exchange" not in physical(recs)
        assert scan_columns(recs) == expected


def test_strict_json_check_runs_python_once(spark):
    lines = spark.createDataFrame([("f", 1, '{"a": 1}'), ("f", 2, "x")], "file string, line long, value string")
    checked = V.check_lines(lines, ["a"]).filter("status <> 'ok'")
    assert physical(checked).count("ArrowEvalPython") == 1


def test_rank_window_is_partitioned_by_bucket(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    p = physical(order.global_rank(df, "k"))
    windows = [line for line in p.splitlines() if "Window [" in line and "row_number" in line]
    assert windows and all("_order_bucket" in w for w in windows)


def test_pack_groups_blocks_by_hash(spark):
    df = spark.createDataFrame([(i, [1] * (i % 7)) for i in range(50)], "id long, input_ids array<int>")
    df = df.withColumn("labels", F.col("input_ids"))
    p = physical(pack(df, "id", 8))
    assert re.search(r"hashpartitioning\(block_id", p)
