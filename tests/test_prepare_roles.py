"""Preparing all roles: a role that fails is an error, not a result without its rows; slices are the whole."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import pack
from quarry.operators.recipes import recipe_for, recipes
from quarry.plans import builders as B
from quarry.plans import catalog as C
from quarry.plans.training_set import prepare, prepare_all
from quarry.session import discard

from .conftest import SF001

BAD_ROW = lambda src: B.docs_generator(src).withColumn("output", F.raise_error(F.lit("disk gone")).cast("string"))
BAD_PLAN = lambda src: B.docs_generator(src.drop("docstring"))


@pytest.mark.parametrize(("broken", "told"), [(BAD_ROW, "disk gone"), (BAD_PLAN, "docstring")])
@pytest.mark.parametrize("query", [C.prepare_all_roles, C.prepare_from_jsonl])
def test_all_roles_are_prepared_or_none(spark, monkeypatch, query, broken, told):
    monkeypatch.setitem(B.BUILDERS, "docs_generator", broken)
    with pytest.raises(RuntimeError, match="docs_generator") if query is C.prepare_from_jsonl else pytest.raises(Exception, match=told):
        query(spark, SF001).collect()


def test_the_first_failure_of_a_role_ends_the_strict_write(spark, monkeypatch, tmp_path):
    src = spark.createDataFrame([(1, "say", "", "word " * 20)], "id long, instruction string, input string, output string")
    monkeypatch.setitem(B.BUILDERS, "copy_writer", B.code_writer)
    roles = ["docs_generator", "copy_writer"]
    with pytest.raises(RuntimeError, match="docs_generator"):
        B.build_and_write({"copy_writer": src}, str(tmp_path / "a"), roles, strict=True)
    with pytest.raises(RuntimeError, match="docs_generator"):
        B.write_together({"copy_writer": src}, str(tmp_path / "b"), roles, strict=True)
    assert not (tmp_path / "a").exists() and not (tmp_path / "b").exists()


def _blocks(frames):
    return sorted((str(r.g), r.block_id, tuple(r.input_ids), tuple(r.labels)) for x in frames for r in x.collect())


@pytest.mark.parametrize("slices", [1, 3, 50])
def test_blocks_in_slices_are_the_blocks(spark, slices):
    rows = [(g, k, None if k % 11 == 3 else "aé" * (k % 13 * n)) for g, n in ((None, 1), ("a", 6)) for k in range(90)]
    df = spark.createDataFrame(rows, "g string, k long, text string")
    sizes = {"partition_by": ["g"], "group_tokens": 32}
    whole = _blocks([pack.pack_bytes(df, "k", 16, **sizes)])
    frames = pack.pack_bytes_slices(df, "k", 16, slices, slice_tokens=64, **sizes)
    assert len(whole) > 60 and whole == _blocks(frames)
    assert min(slices, 4) <= len(frames) <= slices
    empty = pack.pack_bytes_slices(df.limit(0), "k", 16, slices, **sizes)
    assert _blocks(empty) == []


def test_a_slice_shuffles_only_the_texts_that_meet_it(spark):
    df = spark.createDataFrame([(k, "x" * 40) for k in range(400)], "k long, text string")
    frames = pack.pack_bytes_slices(df, "k", 16, 8, group_tokens=32, slice_tokens=64)
    conditions = [x._jdf.queryExecution().optimizedPlan().toString() for x in frames]
    assert len(frames) == 8 and all(p.count("md5(") >= 2 for p in conditions)


def test_prepared_in_slices_from_a_kept_folder(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"Do {i}", "", "ö" * (20 + i)) for i in range(60)], "id long, instruction string, input string, output string")
    recipe = {**recipe_for("code_writer"), "packing": True}
    train, held = prepare(rows, recipe, max_len=64)
    as_sets = lambda *frames: sorted(tuple(r.input_ids) for x in frames for r in x.collect())
    keep = str(tmp_path / "texts")
    trains, kept = prepare(rows, recipe, max_len=64, slices=4, keep=keep)
    assert as_sets(*trains) == as_sets(train) and as_sets(kept) == as_sets(held)
    assert max(len(r.text) for r in spark.read.parquet(keep).collect()) == 64  # no more than a block is kept
    discard(spark, keep)
    assert not (tmp_path / "texts").exists()


@pytest.mark.parametrize("slices", [1, 3])
def test_roles_written_in_slices_are_the_roles(spark, slices):
    root, status = C._write_roles(spark, SF001, slices, strict=True, compression="gzip")
    files = spark.read.option("recursiveFileLookup", "true").text(root).groupBy(F.regexp_extract(F.col("_metadata.file_path"), "(role=.*)/", 1).alias("f"))
    lines = {r.f: r["count"] for r in files.count().collect()}
    assert {r: n for r, n, _ in status} == {r: sum(n for f, n in lines.items() if f.startswith(f"role={r}/")) for r in B.BUILDERS}
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(root).select("path").collect()
    assert len(names) == len(lines) and all(r.path.endswith(".json.gz") for r in names)  # a file for each run of ids


def test_all_roles_prepared_in_slices(spark, tmp_path):
    rows = [(r, i, f"Do {i}", "", "ö" * (20 + i), None) for r in ("code_writer", "docs_generator") for i in range(40)]
    rows += [("static_reviewer", i, None, None, None, [("user", "hi"), ("assistant", "é" * 3000)]) for i in range(9)]
    df = spark.createDataFrame(rows, "role string, id long, instruction string, input string, output string, messages array<struct<role:string,content:string>>")
    table = recipes(spark, {"code_writer": {"max_seq_length": 64}, "docs_generator": {"max_seq_length": 32}})
    as_sets = lambda *frames: sorted((r.role, tuple(r.input_ids)) for x in frames for r in x.collect())
    whole = [as_sets(x) for x in prepare_all(df, table)]
    blocks, plain, held = prepare_all(df, table, slices=3, keep=str(tmp_path / "texts"))
    assert [as_sets(*blocks), as_sets(plain), as_sets(held)] == whole and all(whole)


def test_only_a_strict_write_adds_to_files(spark, tmp_path):
    src = spark.createDataFrame([(1, "say", "", "word " * 20)], "id long, instruction string, input string, output string")
    with pytest.raises(ValueError, match="strict"):
        B.write_together({"code_writer": src}, str(tmp_path / "a"), ["code_writer"], mode="append")
    for mode in ("overwrite", "append"):
        B.write_together({"code_writer": src}, str(tmp_path / "a"), ["code_writer"], mode=mode, strict=True, compression="gzip")
    assert spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "a")).count() == 2


@pytest.mark.parametrize("query", [C.prepare_all_roles, C.prepare_from_jsonl])
def test_large_sources_give_the_rows_of_small_ones(spark, monkeypatch, query):
    monkeypatch.setattr(B, "BUILDERS", {r: B.BUILDERS[r] for r in ("code_writer", "static_reviewer")})
    as_set = lambda: sorted(tuple(r) for r in query(spark, SF001).collect())
    whole = as_set()
    calls, cut = [], pack.pack_bytes_slices
    monkeypatch.setattr(C, "SLICE_BYTES", 1)  # sources of any size are dealt in slices
    monkeypatch.setattr(C, "SLICES", 2)
    monkeypatch.setattr(pack, "pack_bytes_slices", lambda *a, **k: calls.append(a) or cut(*a, **k))
    assert as_set() == whole and len(whole) > 100 and calls
