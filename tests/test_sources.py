"""Sources and sinks, recipes, encoders, the prepare pipeline and the driver contract."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import recipes as R
from quarry.operators import tokenize as K
from quarry.sources import ingest, jsonl, tables

from .conftest import SF001


def test_jsonl_roundtrip_keeps_nulls_and_unicode(spark):
    d = tempfile.mkdtemp(prefix="jsonl-")
    df = spark.createDataFrame([("é {x} 100%", None, "o\n")], "instruction string, input string, output string")
    assert jsonl.write_jsonl(df, d) == 1
    text = "".join(open(os.path.join(d, f), encoding="utf-8").read() for f in os.listdir(d) if f.endswith(".json"))
    assert '"input":null' in text and "é" in text
    back = jsonl.read_jsonl(spark, d).first()
    assert (back.instruction, back.input, back.output) == ("é {x} 100%", None, "o\n")


def test_read_jsonl_skips_blank_and_handles_crlf(spark):
    d = tempfile.mkdtemp(prefix="jsonl-")
    with open(os.path.join(d, "a.jsonl"), "wb") as f:
        f.write(b'{"instruction": "a"}\r\n\r\n   \n{"instruction": "b"}\r\n')
    assert sorted(r.instruction for r in jsonl.read_jsonl(spark, d).collect()) == ["a", "b"]
    assert sorted(r.instruction for r in jsonl.read_cached_dir(spark, d).collect()) == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        jsonl.read_cached_dir(spark, tempfile.mkdtemp(prefix="none-"))


def test_write_roles(spark):
    d = tempfile.mkdtemp(prefix="roles-")
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "z")], "role string, instruction string")
    assert jsonl.write_roles(df, d) == 3
    assert sorted(x for x in os.listdir(d) if x.startswith("role=")) == ["role=a", "role=b"]


def test_resolve_uri():
    assert tables.resolve_uri("data/x.jsonl") == "data/x.jsonl"
    assert tables.resolve_uri("file:///tmp/x") == "file:///tmp/x"
    assert tables.resolve_uri("s3://b/k.jsonl") == "s3a://b/k.jsonl"
    with pytest.raises(ValueError, match="Supported"):
        tables.resolve_uri("gs://b/k")


def test_read_first_available(spark):
    i, df = tables.read_first_available(
        spark, [("/nonexistent/path", None, "parquet"), (SF001, None, "parquet"), lambda: None]
    )
    assert i == 1
    i, df = tables.read_first_available(spark, [("/nope", "train", "json"), lambda: spark.range(3)])
    assert i == 1 and df.count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read_first_available(spark, [("/nope", None, "json")])


def test_incremental_ingest(spark):
    src = tempfile.mkdtemp(prefix="src-")
    manifest = os.path.join(tempfile.mkdtemp(prefix="man-"), "manifest")
    for sub in ("a", "b"):
        os.makedirs(os.path.join(src, sub))
        with open(os.path.join(src, sub, "same.jsonl"), "w") as f:
            f.write('{"instruction": "%s"}\n' % sub)
    new = ingest.new_files(spark, src, manifest)
    assert new.count() == 2  # same name in two directories: both kept
    rows = ingest.read_new(spark, new, jsonl.INSTRUCTION_SCHEMA)
    assert sorted(r.instruction for r in rows.collect()) == ["a", "b"]
    ingest.commit(new, manifest)
    assert ingest.new_files(spark, src, manifest).count() == 0
    with open(os.path.join(src, "b", "same.jsonl"), "w") as f:
        f.write('{"instruction": "c"}\n')  # same size, other content: counted as synced
    assert ingest.new_files(spark, src, manifest).count() == 0
    with open(os.path.join(src, "a", "same.jsonl"), "a") as f:
        f.write('{"instruction": "a2"}\n')  # size changed: ingested again
    assert ingest.new_files(spark, src, manifest).count() == 1
    with pytest.raises(FileNotFoundError):
        ingest.new_files(spark, tempfile.mkdtemp(prefix="empty-"), manifest)


def test_recipes(spark):
    rec = R.recipe_for("static_reviewer")
    assert rec["format"] == "chat" and rec["max_seq_length"] == 4096 and rec["packing"] is False
    with pytest.raises(ValueError, match="Available: code_writer, docs_generator"):
        R.recipe_for("nope")
    df = spark.createDataFrame([("code_writer", "i", "", "o"), ("ghost", "i", "", "o")], "role string, instruction string, input string, output string")
    with pytest.raises(Exception, match="ghost"):
        R.with_recipe(df, R.recipes(spark)).collect()
    ok = R.with_recipe(df.filter("role = 'code_writer'"), R.recipes(spark))
    assert ok.first().max_seq_length == 4096
    assert "BroadcastHashJoin" in ok._jdf.queryExecution().executedPlan().toString()


def test_remap_fields(spark):
    df = spark.createDataFrame([("q", "a")], "question string, answer string")
    fields = {"instruction": "question", "input": "input_missing_ok", "output": "answer"}
    rec = {"format": "instruction", "fields": fields}
    out = R.render(df.withColumn("input_missing_ok", F.lit("")), rec).first().text
    assert out == "### Instruction:\nq\n\n### Input:\n\n\n### Response:\na"
    with pytest.raises(ValueError, match="Unknown format"):
        R.render(df, {"format": "yaml", "fields": {}})


def test_byte_encoder_matches_python(spark):
    texts = ["héllo", "", None, "\U0001F600x", "a" * 50]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for engine in ("arrow", "jvm"):
        got = {r.id: list(r.input_ids) for r in K.byte_encode(df, "text", 8, engine=engine).collect()}
        assert got == {i: list((t or "").encode())[:8] for i, t in enumerate(texts)}


def _whitespace_encoder():
    vocab = {}

    def encode(batch):
        return [[vocab.setdefault(w, len(vocab) + 1) % 1000 for w in t.split()] for t in batch]

    return encode


def test_user_encoder_through_arrow(spark):
    df = spark.createDataFrame([(1, "a b c a"), (2, None)], "id int, text string")
    out = {r.id: (list(r.input_ids), list(r.labels), list(r.attention_mask)) for r in K.encode_with(df, _whitespace_encoder, "text", 3).collect()}
    assert out[1][0] == [1, 2, 3] and out[1][1] == [1, 2, 3] and out[1][2] == [1, 1, 1]
    assert out[2] == ([], [], [])


def test_prepare_pipeline(spark):
    from quarry.operators.recipes import recipe_for
    from quarry.plans.training_set import prepare

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    recs = docs.select(F.col("doc_id").alias("id"), F.lit("i").alias("instruction"), F.lit("").alias("input"), F.col("text").alias("output"))
    train, ev = prepare(recs, recipe_for("code_writer"), max_len=64)
    n = recs.count()
    assert ev.count() == -(-n * 5 // 100)
    blocks = train.collect()
    assert blocks and all(len(b.input_ids) == 64 for b in blocks)
    train2, _ = prepare(recs, recipe_for("static_reviewer") | {"format": "instruction"}, max_len=64)
    assert train2.count() == n - ev.count()  # not packed
    d = tempfile.mkdtemp(prefix="eval-")
    with open(os.path.join(d, "e.jsonl"), "w") as f:
        f.write('{"instruction": "a", "input": "", "output": "b"}\n{"instruction": "c", "input": "", "output": "d"}\n')
    _, ev2 = prepare(recs, recipe_for("code_writer"), max_len=64, eval_path=d)
    assert ev2.count() == 2
    _, ev3 = prepare(recs, recipe_for("code_writer"), max_len=64, eval_path=os.path.join(d, "missing"))
    assert ev3.count() == ev.count()


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    assert E.entry(spark).count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def _bracket_template():
    def template(messages):
        return "".join(f"[{m['role']}]{m['content']}[/]" for m in messages)

    return template


def test_chat_template_hook(spark):
    df = spark.createDataFrame(
        [(1, [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]), (2, [])],
        "id long, messages array<struct<role:string,content:string>>",
    )
    rec = R.recipe_for("static_reviewer")
    got = {r.id: r.text for r in R.render(df, rec, chat_template=_bracket_template).collect()}
    assert got == {1: "[user]hi[/][assistant]yo[/]", 2: ""}
    plain = {r.id: r.text for r in R.render(df, rec).collect()}
    assert plain[1] == "<|user|>\nhi\n<|assistant|>\nyo"


def test_read_source_split_and_role_counts(spark):
    from quarry.operators.stats import role_counts

    d = tempfile.mkdtemp(prefix="src-")
    spark.range(3).write.parquet(os.path.join(d, "train"))
    spark.range(5).write.parquet(os.path.join(d, "test"))
    assert tables.read_source(spark, d, "train").count() == 3
    assert tables.read_source(spark, f"file://{d}", "test").count() == 5
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "role string")
    got = {r.role: r.records for r in role_counts(df).collect()}
    assert got == {"a": 2, "b": 1, None: 3}
