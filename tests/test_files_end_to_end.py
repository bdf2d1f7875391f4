"""From files to files: a role's failure, numbered records, preparing from a path, digests of many files."""

import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import integrity, order
from quarry.operators.recipes import recipe_for
from quarry.plans import builders
from quarry.plans.training_set import prepare_path
from quarry.sources import jsonl


def folder_of(files: dict[str, str]) -> str:
    d = tempfile.mkdtemp(prefix="files-")
    for name, body in files.items():
        path = os.path.join(d, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", newline="") as f:
            f.write(body)
    return d


def test_a_role_that_fails_in_a_task_leaves_the_others(spark):
    src = spark.createDataFrame([(1, "say", "", "word " * 20)], "id long, instruction string, input string, output string")
    broken = src.withColumn("output", F.when(F.col("id") == 1, F.raise_error(F.lit("disk gone"))).otherwise(F.col("output")))
    builders.register("copy_writer", builders.code_writer)
    try:
        d = tempfile.mkdtemp(prefix="roles-")
        status = builders.build_and_write(
            {"code_writer": broken, "copy_writer": src}, d, roles=["code_writer", "copy_writer", "docs_generator"]
        )
    finally:
        del builders.BUILDERS["copy_writer"]
    by_role = {role: (records, error) for role, records, error in status}
    assert by_role["code_writer"][0] is None and "disk gone" in by_role["code_writer"][1]
    assert by_role["copy_writer"] == (1, None) and "KeyError" in by_role["docs_generator"][1]
    assert jsonl.read_cached_dir(spark, f"{d}/role=copy_writer").count() == 1


def test_numbered_records_and_broken_lines(spark):
    line = '{"instruction": "%s", "input": null, "output": "y"}\n'
    d = folder_of({"a b.jsonl": line % "p" + "\n" + line % "q", "sub/c%d.jsonl": line % "p"})
    got = {(os.path.basename(r.file), r.line, r.instruction) for r in jsonl.read_numbered(spark, d).collect()}
    assert got == {("a b.jsonl", 1, "p"), ("a b.jsonl", 3, "q"), ("c%d.jsonl", 1, "p")}
    plan = jsonl.read_numbered(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    for bad in ('{"instruction": "a"} x\n', "{'instruction': 'a'}\n"):
        with pytest.raises(Exception, match="line is no JSON object"):
            jsonl.read_numbered(spark, folder_of({"x.jsonl": bad})).collect()


def test_prepare_from_a_path_and_an_eval_file(spark):
    line = '{"instruction": "do %d", "input": "", "output": "done"}\n'
    d = folder_of({"train/t.jsonl": "".join(line % i for i in range(40)), "eval.jsonl": line % 99})
    recipe = recipe_for("code_writer") | {"packing": False}
    train, held = prepare_path(spark, f"{d}/train", recipe)
    assert (train.count(), held.count()) == (38, 2)
    train, held = prepare_path(spark, f"{d}/train", recipe, eval_path=f"{d}/eval.jsonl")
    assert (train.count(), held.count()) == (40, 1)
    packed, _ = prepare_path(spark, f"{d}/train", recipe | {"packing": True}, max_len=64)
    assert {len(r.input_ids) for r in packed.collect()} == {64}


def test_digests_of_many_files(spark, monkeypatch):
    body = '{"a": 1}\n'
    d = folder_of({"a b.jsonl": body, "sub/c.jsonl": body, "e.jsonl": body * 9})
    good = hashlib.sha256(body.encode()).hexdigest()
    path = lambda n: f"file://{d}/{n}"
    wanted = spark.createDataFrame([(path("a b.jsonl"), good), (path("sub/c.jsonl"), "0" * 64)], "file string, sha256 string")
    failed = lambda x: sorted((os.path.basename(r.file), r.issue) for r in integrity.validate(spark, d, ["a"], x).collect())
    assert failed(wanted) == [("c.jsonl", "sha256")]
    monkeypatch.setattr(integrity, "MAX_DIGEST_BYTES", len(body))
    assert failed(good) == [("e.jsonl", "too_large")]


@pytest.mark.parametrize("fraction", [0.0, 0.3, 1.0])
def test_split_cut_per_group(spark, fraction):
    rows = [(g, k) for g, n in ((None, 50), ("a", 1), ("b", 7)) for k in range(n)]
    df = spark.createDataFrame(rows, "g string, k long")
    ranked = order.global_rank(df, "k", partition_by=["g"])
    size = ranked.groupBy("g").count().collect()
    n_eval = {r.g: -(-r["count"] * int(fraction * 10) // 10) for r in size}
    exp = {(r.g, r.k): "eval" if r.rank <= n_eval[r.g] else "train" for r in ranked.collect()}
    assert {(r.g, r.k): r.split for r in order.split(df, "k", fraction, partition_by=["g"]).collect()} == exp
