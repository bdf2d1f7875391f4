"""What the writers of all roles and the preparation move: rows built from the sources are not shuffled, read or written twice."""

import tempfile

from pyspark.sql import functions as F

from quarry.operators.recipes import recipe_for
from quarry.plans import builders as B
from quarry.plans import catalog as C
from quarry.plans.training_set import prepare

from .conftest import SF001


def test_built_rows_are_written_without_a_shuffle(spark, monkeypatch):
    seen = []

    def keep(sources, root, options=None, layout=None, partition_by=(), **more):
        for role, src in sources.items():
            seen.append((role, layout(B.BUILDERS[role](src, **(options or {}).get(role, {})).withColumn("role", F.lit(role)))))
        return []

    for name, write in (("build_and_write", C._write_roles), ("write_together", C._write_together)):
        monkeypatch.setattr(B, name, keep)
        write(spark, SF001)
    assert len(seen) == 2 * len(B.BUILDERS)
    for role, rows in seen:
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition" not in plan and "Aggregate" not in plan, role
        pairs = rows.select("chunk", F.spark_partition_id().alias("p")).distinct().collect()
        assert len(pairs) == len({r.chunk for r in pairs}), role  # a file for each run of ids


def test_a_failing_row_is_met_before_files_are_written(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    calls, text = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, *a, **k: calls.append(a) or text(self, *a, **k))
    src = spark.createDataFrame([(i, "Do", "", "x" * 30) for i in range(6)], "id long, instruction string, input string, output string")
    bad = F.when(F.col("id") == 4, F.raise_error(F.lit("bad row"))).otherwise(F.col("output"))
    monkeypatch.setitem(B.BUILDERS, "broken", lambda s: B.code_writer(s).withColumn("output", bad.cast("string")))
    root = tempfile.mkdtemp(prefix="writers-")
    status = B.write_together({"code_writer": src, "broken": src}, root, ["code_writer", "broken"], rehearse=True)
    assert [(r, n, e is None) for r, n, e in status] == [("code_writer", 6, True), ("broken", None, False)]
    assert not calls
    status = B.write_together({"code_writer": src}, root, ["code_writer"], rehearse=True, compression="lz4")
    assert status == [("code_writer", 6, None)] and len(calls) == 1
    assert spark.read.option("recursiveFileLookup", "true").text(root).count() == 6


def test_records_are_read_once_for_all_steps(spark):
    read = spark.sparkContext.accumulator(0)

    def count(text):
        read.add(1)
        return text

    rows = spark.createDataFrame([(i, "Do", "", "x" * (20 + i)) for i in range(40)], "id long, instruction string, input string, output string")
    rows = rows.withColumn("output", F.udf(count, "string").asNondeterministic()("output"))
    train, held = prepare(rows, {**recipe_for("code_writer"), "packing": True}, max_len=64)
    assert train.count() > 0 and held.count() == 2
    train.collect(), held.collect()
    assert read.value == 40
