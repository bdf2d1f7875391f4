"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (or what Spark derives from them) in
full; the SQL twin of each lives in ``oracle.py`` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.docstring import with_docstring_stripped
from ..functions.render import render_chat
from ..operators import order
from ..sources import fixtures as fx
from . import builders as B
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]


def _docs(spark, sf):
    return fx.table(spark, sf, "documents")


def _conv(spark, sf):
    return fx.table(spark, sf, "conversations")


def code_writer_records(spark, sf):
    return B.code_writer(fx.instructions(_docs(spark, sf)))


def test_pairs_capped(spark, sf):
    return B.test_generator(fx.unit_tests(_docs(spark, sf), as_structs=True))


def test_pairs_json(spark, sf):
    """The tests come as JSON text instead of an array."""
    problems = fx.unit_tests(_docs(spark, sf), as_structs=True)
    return B.test_generator(problems.withColumn("unit_tests", F.to_json("unit_tests")))


def test_pairs_joined(spark, sf):
    return B.test_generator_fallback(fx.problems(_docs(spark, sf)))


def _chat_summary(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        F.size("messages").cast("long").alias("n_messages"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        render_chat("messages").alias("transcript"),
    )


def review_chats(spark, sf):
    return _chat_summary(B.static_reviewer(fx.chats(_conv(spark, sf)), keywords=O.REVIEW_QUERY_KEYWORDS))


def lang_filtered_pairs(spark, sf):
    return B.security_auditor(fx.security_pairs(_docs(spark, sf)), langs=O.SECURITY_QUERY_LANGS)


def optimization_records(spark, sf):
    return B.performance_optimizer(fx.chats(_conv(spark, sf)), groups=O.OPT_QUERY_GROUPS)


def docstring_strip(spark, sf):
    f = fx.functions(_docs(spark, sf)).filter(F.col("code").isNotNull())
    return with_docstring_stripped(f, "code", "stripped").select("id", "stripped")


def docs_records(spark, sf):
    return B.docs_generator(fx.functions(_docs(spark, sf)))


def shuffle_rank(spark, sf):
    return order.global_rank(code_writer_records(spark, sf), "id", fixed.SEED).select("id", "rank")


def _grouped_docs(spark, sf) -> DataFrame:
    """Documents in groups by language, French ones in the null group."""
    return _docs(spark, sf).select("doc_id", "text", F.nullif("lang", F.lit("fr")).alias("g"))


def rank_by_group(spark, sf):
    ranked = order.global_rank(_grouped_docs(spark, sf).drop("text"), "doc_id", partition_by=["g"])
    return ranked.select("g", "doc_id", "rank")


def sample_n(spark, sf):
    recs = code_writer_records(spark, sf)
    capped = order.sample_n(recs, "id", O.SAMPLE_N, fixed.SEED, rank_col="rank")
    return capped.select("id", "rank", "instruction", "input", "output")


def train_eval_split(spark, sf):
    return order.split(code_writer_records(spark, sf), "id", fixed.EVAL_FRACTION, fixed.SEED).select("id", "split")


def split_stats(spark, sf):
    from ..operators.stats import split_stats as stats

    return stats(train_eval_split(spark, sf))


# ---------------------------------------------------------------------------
# Rendering, recipes, all roles, stats, sinks
# ---------------------------------------------------------------------------


def role_sources(spark, sf, docs: DataFrame | None = None, chats: DataFrame | None = None) -> dict[str, DataFrame]:
    docs = _docs(spark, sf) if docs is None else docs
    # One plan for both chat roles, so the exchange can be reused.
    chats = fx.chats(_conv(spark, sf)) if chats is None else chats
    return {
        "code_writer": fx.instructions(docs),
        "test_generator": fx.unit_tests(docs),
        "static_reviewer": chats,
        "security_auditor": fx.security_pairs(docs),
        "performance_optimizer": chats,
        "docs_generator": fx.functions(docs),
    }


ROLE_OPTIONS = {
    "static_reviewer": {"keywords": O.REVIEW_QUERY_KEYWORDS},
    "security_auditor": {"langs": O.SECURITY_QUERY_LANGS},
    "performance_optimizer": {"groups": O.OPT_QUERY_GROUPS},
}


def all_records(spark, sf) -> DataFrame:
    recs, failures = B.build_all(role_sources(spark, sf), options=ROLE_OPTIONS)
    if failures:
        raise RuntimeError(f"roles failed: {failures}")
    return recs


def instruction_text(spark, sf):
    from ..operators.recipes import recipe_for, render

    recs = code_writer_records(spark, sf)
    return render(recs, recipe_for("code_writer")).select("id", "text")


def chat_text(spark, sf):
    from ..operators.recipes import recipe_for, render

    recs = B.static_reviewer(fx.chats(_conv(spark, sf)), keywords=O.REVIEW_QUERY_KEYWORDS)
    return render(recs, recipe_for("static_reviewer")).select("id", "text")


def recipe_join(spark, sf):
    from ..operators.recipes import recipes, with_recipe

    joined = with_recipe(all_records(spark, sf), recipes(spark))
    return joined.select("role", "id", "format", F.col("max_seq_length").cast("long").alias("max_seq_length"), "packing")


def build_all(spark, sf):
    from ..operators.recipes import recipes, render_by_recipe, with_recipe

    rendered = render_by_recipe(with_recipe(all_records(spark, sf), recipes(spark)))
    return rendered.select("role", "id", "text")


def custom_roles_text(spark, sf):
    """Two roles that the recipe table does not have, with columns of other names."""
    from ..operators.recipes import recipes, render_by_recipe, with_recipe

    added = {
        "brief": {"fields": {"instruction": "ask", "input": "input", "output": "reply"}, "max_seq_length": 1024},
        "audit": {"format": "chat", "fields": {"messages": "turns"}, "packing": True},
    }
    brief = code_writer_records(spark, sf).withColumnsRenamed({"instruction": "ask", "output": "reply"})
    audit = B.static_reviewer(fx.chats(_conv(spark, sf)), keywords=O.REVIEW_QUERY_KEYWORDS)
    audit = audit.withColumnRenamed("messages", "turns").withColumn("role", F.lit("audit"))
    both = brief.withColumn("role", F.lit("brief")).unionByName(audit, allowMissingColumns=True)
    return render_by_recipe(with_recipe(both, recipes(spark, added))).select("role", "id", "packing", "text")


def source_fallback(spark, sf):
    """The first source is not there, the second has no such split, the third has it."""
    from ..session import scratch_path
    from ..sources.tables import read_first_available

    root = scratch_path(spark, "splits")
    held = F.col("doc_id") % 5 == 0
    _docs(spark, sf).filter(~held).write.parquet(f"{root}/train")
    _docs(spark, sf).filter(held).write.parquet(f"{root}/test")
    tried = [(f"{root}-none", "train", "parquet"), (root, "validation", "parquet"), (root, "train", "parquet")]
    which, found = read_first_available(spark, tried)
    return found.select("doc_id", F.lit(which).cast("long").alias("source_index"))


def split_column(spark, sf):
    """Splits as a column of the folders: the first source is missing, the second has no such value; both splits are read."""
    from ..session import scratch_path
    from ..sources.tables import read_first_available

    root = scratch_path(spark, "split-column")
    held = F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train")
    _docs(spark, sf).withColumn("split", held).write.partitionBy("split").parquet(root)
    sides = []
    for split in ("train", "test"):
        tried = [(f"{root}-none", split, "parquet", "split"), (root, "validation", "parquet", "split"), (root, split, "parquet", "split")]
        which, found = read_first_available(spark, tried)
        sides.append(found.select("doc_id", F.lit(split).alias("split"), F.lit(which).cast("long").alias("source_index")))
    return reduce(DataFrame.unionByName, sides)


def fallback_builder(spark, sf):
    """The table of structured tests is missing, so the problems with test lists are built by the other builder."""
    from ..session import scratch_path
    from ..sources.tables import read_first_available

    missing = scratch_path(spark, "no-unit-tests")
    tried = [
        lambda: B.test_generator(spark.read.parquet(missing)),
        lambda: B.test_generator_fallback(fx.problems(_docs(spark, sf))),
    ]
    which, records = read_first_available(spark, tried)
    return records.withColumn("source_index", F.lit(which).cast("long"))


def dataset_stats(spark, sf):
    from ..operators.stats import dataset_stats as stats
    from ..sources.jsonl import to_lines

    recs = all_records(spark, sf)
    inst = to_lines(recs.filter(F.col("messages").isNull()), ["instruction", "input", "output"]).select("role", "line")
    chats = to_lines(recs.filter(F.col("messages").isNotNull()), ["messages"]).select("role", "line")
    return stats(inst.unionByName(chats))


def jsonl_roundtrip(spark, sf):
    from ..session import scratch_path
    from ..sources.jsonl import read_jsonl, write_roles

    recs = code_writer_records(spark, sf).withColumn("role", F.lit("code_writer"))
    root = scratch_path(spark, "jsonl-roundtrip")
    write_roles(B.ordered(recs).drop("id"), root)
    return read_jsonl(spark, f"{root}/role=code_writer")


def cached_dir(spark, sf):
    from ..session import scratch_path
    from ..sources.jsonl import read_cached_dir, write_jsonl

    root = scratch_path(spark, "cached-dir")
    write_jsonl(code_writer_records(spark, sf).drop("id"), root)
    return read_cached_dir(spark, root)


def jsonl_rejects(spark, sf):
    """The damaged event lines as files: lines that are records, and lines that are not beside them."""
    from ..session import scratch_path
    from ..sources.jsonl import split_jsonl

    root = scratch_path(spark, "reject-lines")
    lines = event_lines(fx.table(spark, sf, "events")).withColumn("part", F.floor((F.col("line") - 1) / O.EVENT_FILE_LINES))
    lines.repartition("part").sortWithinPartitions("part", "line").select("part", "value").write.partitionBy("part").text(root)
    records, rejects, counts = split_jsonl(spark, root, f"{root}-split", "k long", REQUIRED_KEYS)
    told = [F.lit(counts[k]).cast("long").alias(f"all_{k}") for k in ("records", "rejects")]
    good = records.select(_part("file").alias("part"), "line", "k", F.lit(None).cast("string").alias("issue"), F.lit(None).cast("string").alias("value"), *told)
    return good.unionByName(rejects.select(_part("file").alias("part"), "line", F.lit(None).cast("long").alias("k"), "issue", "value", *told))


#: Sources are dealt, and the stream of a role is packed, in at most so many slices; sources of so many bytes at least.
SLICES = 3
SLICE_BYTES = 32 << 20


def _source_slices(spark, sf) -> int:
    """How many slices the sources are dealt in, so that their copy on disk is a small part of the input."""
    size = lambda df: int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, min(SLICES, (size(_docs(spark, sf)) + size(_conv(spark, sf))) // SLICE_BYTES))


def _dealt_sources(spark, sf, part: int = 0, of: int = 1) -> tuple[dict[str, DataFrame], DataFrame]:
    """(``role_sources``, documents) where each run of ROLE_FILE_IDS ids lies in one partition.

    Builders filter and project, so their rows, several times the sources, lie alike and need no shuffle of their own.
    ``part`` of ``of``: only every so many-th run; the parts together are the whole."""
    from ..session import materialize

    def dealt(df: DataFrame, key: str) -> DataFrame:
        run = F.floor(F.col(key) / O.ROLE_FILE_IDS)
        if of > 1:
            df = df.filter(F.coalesce(F.pmod(run, F.lit(of)), F.lit(0)) == part)
        return materialize(df.repartition(run).sortWithinPartitions(key))

    docs = dealt(_docs(spark, sf), "doc_id")
    return role_sources(spark, sf, docs, dealt(fx.chats(_conv(spark, sf)), "id")), docs


def _write_together(spark, sf, broken: tuple[str, ...] = (), slices: int = 1, **options) -> tuple[str, list]:
    """Every role as JSONL by one job a slice, a file per role and run of ROLE_FILE_IDS ids; (root, status).

    ``broken`` names more roles, built from the instructions."""
    from ..session import release, scratch_path

    def layout(recs: DataFrame) -> DataFrame:
        recs = recs.withColumn("chunk", F.floor(F.col("id") / O.ROLE_FILE_IDS))
        return recs.sortWithinPartitions("role", "chunk", "id")

    def write(part: int) -> list:
        sources, docs = _dealt_sources(spark, sf, part, slices)
        sources |= {role: fx.instructions(docs) for role in broken}
        if slices > 1:
            release(spark)  # the shuffle of the sources, which are copied
        mode = {"mode": "append"} if part else {}
        return B.write_together(sources, root, options=ROLE_OPTIONS, layout=layout, partition_by=["chunk"], **mode, **options)

    root = scratch_path(spark, "all-role-files")
    return root, _in_slices(spark, write, slices)


def write_status_failing(spark, sf):
    """One role fails on some row and one has no source; the others are written whole."""
    bad = F.when(F.col("id") % 3 == 1, F.raise_error(F.lit("bad row"))).otherwise(F.col("output"))
    B.register("broken_role", lambda src: B.code_writer(src).withColumn("output", bad.cast("string")))
    B.register("sourceless_role", B.code_writer)
    try:
        root, status = _write_together(spark, sf, ("broken_role",), rehearse=True)
    finally:
        for role in ("broken_role", "sourceless_role"):
            B.BUILDERS.pop(role)
    read = spark.read.option("recursiveFileLookup", "true").text(root)
    found = read.groupBy(F.regexp_extract(F.col("_metadata.file_path"), "role=([^/]*)", 1).alias("role")).agg(F.count(F.lit(1)).alias("lines"))
    told = spark.createDataFrame([(r, n, e is not None) for r, n, e in status], "role string, records long, failed boolean")
    return told.join(found, "role", "left")


def prepare_all_roles(spark, sf):
    """All roles written by one job a slice, read back once, split, encoded and packed by the table of their recipes.

    The texts and shuffles of all roles at once would take more disk than the files: sources of more than one slice are
    prepared a role after the other, smaller ones in one plan."""
    from pyspark.sql import types as T

    from ..operators.recipes import recipes
    from ..session import discard, materialize, release, scratch_path
    from ..sources.jsonl import CHAT_SCHEMA, INSTRUCTION_SCHEMA, read_numbered
    from ..sources.tables import has_files
    from .training_set import prepare_all

    # These files are read once, here: they need not take their full size.
    slices = _source_slices(spark, sf)
    root, _ = _write_together(spark, sf, slices=slices, compression="gzip", strict=True)

    def side(rows: DataFrame, part: str, item: F.Column) -> DataFrame:
        n = F.size("input_ids").cast("long").alias("n_tokens")
        return rows.select("role", F.lit(part).alias("part"), item.alias("item"), n, F.md5(F.array_join("input_ids", ",")).alias("ids_md5"))

    named = F.concat_ws(":", "file", "line")

    def records_of(path: str) -> DataFrame:
        records = read_numbered(spark, path, T.StructType([*INSTRUCTION_SCHEMA.fields, *CHAT_SCHEMA.fields]))
        records = records.withColumn("file", F.regexp_extract("file", "(role=.*)/", 1))
        return records.withColumn("role", F.regexp_extract("file", "role=([^/]*)", 1))

    def prepared(role: str) -> list[DataFrame]:
        """The role's rows, written; what they were made of is out of use then."""
        records = records_of(f"{root}/role={role}")
        texts = scratch_path(spark, "role-texts")
        blocks, plain, held = prepare_all(records, recipes(spark), ["file", "line"], slices=SLICES, keep=texts)
        sides = []
        for part in blocks:
            sides.append(materialize(side(part, "train", F.col("block_id").cast("string"))))
            release(spark)  # the shuffles of the slice
        sides += [materialize(side(plain, "train", named)), materialize(side(held, "eval", named))]
        discard(spark, texts)
        return sides

    if slices == 1:
        blocks, plain, held = prepare_all(records_of(root), recipes(spark), ["file", "line"])
        return reduce(DataFrame.unionByName, [side(blocks, "train", F.col("block_id").cast("string")), side(plain, "train", named), side(held, "eval", named)])
    sides = []
    for role in B.BUILDERS:
        # A role without a record has no files.
        sides += prepared(role) if has_files(spark, f"{root}/role={role}") else []
        release(spark)
    return reduce(DataFrame.unionByName, sides)


def _write_roles(spark, sf, slices: int = 1, **options) -> tuple[str, list]:
    """Every role as JSONL, a file per role and run of ROLE_FILE_IDS ids, so that lines are known; (root, status).

    With ``slices`` the sources are dealt and written in so many parts, one after the other."""
    from ..session import release, scratch_path

    def layout(recs: DataFrame) -> DataFrame:
        recs = recs.withColumn("chunk", F.floor(F.col("id") / O.ROLE_FILE_IDS))
        return recs.sortWithinPartitions("chunk", "id").drop("id")

    def write(part: int) -> list:
        sources = _dealt_sources(spark, sf, part, slices)[0]
        if slices > 1:
            release(spark)  # the shuffle of the sources, which are copied
        return B.build_and_write(sources, root, options=ROLE_OPTIONS, layout=layout, partition_by=["chunk"], mode="append" if part else "overwrite", **options)

    root = scratch_path(spark, "role-files")
    return root, _in_slices(spark, write, slices)


def _in_slices(spark, write: Callable[[int], list], slices: int) -> list:
    """The status of all roles after ``write`` of each slice: records in all, or the first error."""
    from ..session import release

    told: dict[str, tuple] = {}
    for part in range(slices):
        for role, n, error in write(part):
            _, m, before = told.get(role, (role, 0, None))
            error = before or error
            told[role] = (role, None if error else m + n, error)
        if slices > 1:
            release(spark)  # the slice's copy of the sources
    return list(told.values())


def write_status(spark, sf):
    _, status = _write_roles(spark, sf)
    return spark.createDataFrame(status, "role string, records long, error string")


def prepare_from_jsonl(spark, sf):
    """All roles written as JSONL, read back by file and line, split, encoded and packed by their recipes."""
    from ..operators.recipes import recipe_for
    from ..session import discard, materialize, release, scratch_path
    from ..sources.jsonl import read_numbered
    from .training_set import prepare, record_schema

    slices = _source_slices(spark, sf)
    root, _ = _write_roles(spark, sf, slices, strict=True, compression="gzip")

    def prepared(role: str) -> list[DataFrame]:
        """The role's rows; from sources of more than one slice they are written, so that what they were made of is out of use."""
        recipe = recipe_for(role)
        records = read_numbered(spark, f"{root}/role={role}", record_schema(recipe))
        # Part files have random names; their folder says as much, as it has one file.
        records = records.withColumn("file", F.regexp_extract("file", "(role=.*)/", 1))
        texts = scratch_path(spark, "role-texts") if slices > 1 else None
        train, held = prepare(records, recipe, ["file", "line"], slices=SLICES if texts else None, keep=texts)
        sides = []
        for part, side in [*[("train", x) for x in (train if texts else [train])], ("eval", held)]:
            item = F.col("block_id").cast("string") if "block_id" in side.columns else F.concat_ws(":", "file", "line")
            rows = side.select(
                F.lit(role).alias("role"),
                F.lit(part).alias("part"),
                item.alias("item"),
                F.size("input_ids").cast("long").alias("n_tokens"),
                F.md5(F.array_join("input_ids", ",")).alias("ids_md5"),
            )
            sides.append(materialize(rows) if texts else rows)
            if texts:
                release(spark)  # the shuffles of the slice
        if texts:
            discard(spark, texts)
        return sides

    sides = []
    for role in B.BUILDERS:
        sides += prepared(role)
        if slices > 1:
            release(spark)
    return reduce(DataFrame.unionByName, sides)


def prepare_eval_file(spark, sf):
    """The code_writer records are all training data, as the evaluation side is a JSONL file of another role."""
    from ..operators.recipes import recipe_for
    from ..session import scratch_path
    from ..sources.jsonl import write_roles
    from .training_set import prepare

    recs = all_records(spark, sf)
    root = scratch_path(spark, "eval-file")
    held = recs.filter(F.col("role") == "docs_generator")
    write_roles(held.select("role", "instruction", "input", "output"), root)
    recipe = {**recipe_for("code_writer"), "packing": False}
    train = recs.filter(F.col("role") == "code_writer").select("id", "instruction", "input", "output")
    train, held = prepare(train, recipe, eval_path=f"{root}/role=docs_generator")
    sides = [
        side.select(
            F.lit(part).alias("part"),
            F.size("input_ids").cast("long").alias("n_tokens"),
            F.md5(F.array_join("input_ids", ",")).alias("ids_md5"),
        )
        for part, side in (("train", train), ("eval", held))
    ]
    return reduce(DataFrame.unionByName, sides)


# ---------------------------------------------------------------------------
# Validation
# ---------------------------------------------------------------------------

REQUIRED_KEYS = ["k"]


def event_lines(events: DataFrame) -> DataFrame:
    """events.props as the lines of one JSONL log, with fixed kinds of damage:
    truncated (error), single-quoted (cheap signups), wrapped in a list (big
    views), key renamed (cheap clicks), blank (cheap purchases)."""
    p, v, t = F.col("props"), F.col("value"), F.col("event_type")
    value = (
        F.when(t == "error", F.expr("substring(props, 1, length(props) - 1)"))
        .when((t == "signup") & (v < 10), F.replace(p, F.lit('"'), F.lit("'")))
        .when((t == "view") & (v > 30), F.concat(F.lit("["), p, F.lit("]")))
        .when((t == "click") & (v < 5), F.replace(p, F.lit('"k"'), F.lit('"j"')))
        .when((t == "purchase") & (v < 2), F.lit("   "))
        .otherwise(p)
    )
    return events.select(
        F.lit("events.jsonl").alias("file"), (F.col("event_id") + 1).alias("line"), value.alias("value")
    )


def validation_report(spark, sf):
    from ..operators.integrity import validate_lines

    failures, _ = validate_lines(event_lines(fx.table(spark, sf, "events")), REQUIRED_KEYS)
    return failures.select("file", "line", "issue")


def validation_counts(spark, sf):
    from ..operators.integrity import validate_lines

    _, counts = validate_lines(event_lines(fx.table(spark, sf, "events")), REQUIRED_KEYS)
    return counts


def _validated_files(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(report, counts) of the event lines laid out as files of EVENT_FILE_LINES lines.

    Every fifth file is blank only, one has no bytes, every fourth is given a wrong digest; splits are small."""
    from ..operators.integrity import validate_files
    from ..session import scratch_path
    from ..sources.tables import file_listing

    root = scratch_path(spark, "event-files")
    lines = event_lines(fx.table(spark, sf, "events"))
    lines = lines.withColumn("part", F.floor((F.col("line") - 1) / O.EVENT_FILE_LINES))
    lines = lines.withColumn("value", F.when(F.col("part") % 5 == 3, " ").otherwise(F.col("value")))
    laid = lines.repartition("part").sortWithinPartitions("part", "line").select("part", "value")
    laid.write.partitionBy("part").text(root)
    spark.createDataFrame([], "value string").write.text(f"{root}/part=-1")
    body = F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]))
    digests = lines.groupBy("part").agg(F.sha2(F.concat(body, F.lit("\n")), 256).alias("sha256"))
    digests = digests.withColumn("sha256", F.when(F.col("part") % 4 == 1, F.repeat(F.lit("0"), 64)).otherwise(F.col("sha256")))
    files = file_listing(spark, root).select(F.col("path").alias("file"), _part("path").alias("part"))
    # Splits are small, but a task reads many of them: else tasks, and what each sends to the driver, would grow by 4 KB.
    size, tasks = "spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum"
    before = {conf: spark.conf.get(conf, None) for conf in (size, tasks)}
    spark.conf.set(size, "4096")
    spark.conf.set(tasks, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        return validate_files(spark, root, REQUIRED_KEYS, files.join(digests, "part"))
    finally:
        for conf, value in before.items():
            spark.conf.unset(conf) if value is None else spark.conf.set(conf, value)


def _part(c) -> F.Column:
    return F.regexp_extract(c, "part=(-?[0-9]+)", 1).cast("long")


def validate_files(spark, sf):
    report, _ = _validated_files(spark, sf)
    told = F.col("issue").isin("missing_fields", "not_object", "no_records", "empty")
    return report.select(_part("file").alias("part"), "line", "issue", F.when(told, F.col("detail")).alias("detail"))


def validate_files_first(spark, sf):
    from ..operators.integrity import first_failures

    report, _ = _validated_files(spark, sf)
    return first_failures(report).select(_part("file").alias("part"), "line", "issue")


def validate_files_counts(spark, sf):
    _, counts = _validated_files(spark, sf)
    return counts.select(_part("file").alias("part"), "records")


# ---------------------------------------------------------------------------
# Encoding, packing, collation (the prepare pipeline on code_writer records)
# ---------------------------------------------------------------------------

PACK_LEN = 4096
BATCH = 8


def _train_tokens(spark, sf) -> DataFrame:
    from ..operators.recipes import recipe_for, render
    from ..operators.tokenize import byte_encode

    text = render(code_writer_records(spark, sf), recipe_for("code_writer")).select("id", "text")
    train = order.split(text, "id").filter(F.col("split") == "train").drop("split")
    return byte_encode(train, "text", PACK_LEN)


def byte_tokens(spark, sf):
    from ..operators.recipes import recipe_for, render
    from ..operators.tokenize import byte_encode

    text = render(code_writer_records(spark, sf), recipe_for("code_writer")).select("id", "text")
    tok = byte_encode(text, "text", PACK_LEN)
    return tok.select(
        "id",
        F.size("input_ids").cast("long").alias("n_tokens"),
        F.md5(F.array_join("input_ids", ",")).alias("ids_md5"),
        F.md5(F.array_join("labels", ",")).alias("labels_md5"),
        F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"),
    )


def pack_positions(spark, sf):
    from ..operators.pack import sample_starts

    starts = sample_starts(_train_tokens(spark, sf), "id", PACK_LEN)
    return starts.select("id", "pack_start", F.col("pack_sep").cast("long").alias("pack_sep"), "length")


def pack_stats(spark, sf):
    from ..operators.pack import pack_stats as stats
    from ..operators.pack import sample_starts

    return stats(sample_starts(_train_tokens(spark, sf), "id", PACK_LEN), PACK_LEN)


def pack_by_group(spark, sf):
    """Starts per group with a null group, many chunks and several levels of the chunk scan."""
    from ..operators.pack import sample_starts
    from ..operators.tokenize import byte_encode

    tok = byte_encode(_grouped_docs(spark, sf), "text", PACK_LEN)
    starts = sample_starts(tok, "doc_id", PACK_LEN, partition_by=["g"], chunk_rows=50, fanout=3)
    return starts.select("g", "doc_id", "pack_start", F.col("pack_sep").cast("long").alias("pack_sep"), "length")


def pack_blocks(spark, sf):
    from ..operators.pack import pack

    blocks = pack(_train_tokens(spark, sf).drop("labels"), "id", PACK_LEN, eos_id=0)
    return blocks.select(
        "block_id",
        F.md5(F.array_join("input_ids", ",")).alias("ids_md5"),
        F.md5(F.array_join("labels", ",")).alias("labels_md5"),
        F.size(F.filter("labels", lambda x: x == -100)).cast("long").alias("separators"),
        F.size("attention_mask").cast("long").alias("mask_len"),
    )


def collated_batches(spark, sf):
    from ..operators.collate import collate
    from ..operators.recipes import recipe_for, render
    from ..operators.tokenize import byte_encode

    text = render(code_writer_records(spark, sf), recipe_for("code_writer")).select("id", "text")
    ev = order.split(text, "id").filter(F.col("split") == "eval").drop("split")
    tok = byte_encode(ev, "text", 4096)
    out = collate(tok, "id", BATCH, pad_id=0)
    return out.select(
        "id",
        "batch",
        F.size("input_ids").cast("long").alias("padded_len"),
        F.md5(F.array_join("input_ids", ",")).alias("ids_md5"),
        F.md5(F.array_join("labels", ",")).alias("labels_md5"),
        F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"),
    )


# ---------------------------------------------------------------------------
# Metric monitors (batch and stream) and incremental ingest
# ---------------------------------------------------------------------------


def _metrics(spark, sf):
    return fx.metrics(fx.table(spark, sf, "events"))


def divergence_batch(spark, sf):
    from ..operators.monitor import divergence

    d = divergence(_metrics(spark, sf))
    return d.select("run", "step", "eval_loss", "best_loss", "is_bad", "bad_streak", "should_stop")


def _events_stream(spark, sf):
    from ..streaming.monitors import metrics_stream

    ev = fx.table(spark, sf, "events")
    # A glob (not a bare file path) so the file source can list it.
    s = metrics_stream(spark, f"{sf.rstrip('/')}/event[s].parquet", ev.schema)
    return s.select(F.col("user_id").alias("run"), "ts", "event_id", F.col("value").alias("eval_loss"))


def divergence_stream(spark, sf):
    from ..streaming.scans import divergence_scan

    return divergence_scan(_events_stream(spark, sf), tie="event_id")


def divergence_keyed(spark, sf):
    """The same by a state per key, which drops idle runs by itself; a run's rows of a batch meet in one task."""
    from ..streaming.monitors import divergence_stream as stream
    from ..streaming.monitors import run_available

    return run_available(stream(_events_stream(spark, sf), tie="event_id", idle_timeout_ms=10**12), "divergence-keyed")


def _resumed(spark, sf, name: str, monitor) -> DataFrame:
    """The events land in three parts by time; the stream is stopped and started again after each."""
    from ..session import scratch_path
    from ..streaming.monitors import metrics_stream

    ev = fx.table(spark, sf, "events")
    third, two_thirds = ev.select(F.percentile_approx("ts", [1 / 3, 2 / 3])).first()[0]
    t, landed, out = F.col("ts"), scratch_path(spark, f"{name}-log"), scratch_path(spark, name)
    for part in (t <= third, (t > third) & (t <= two_thirds), t > two_thirds):
        ev.filter(part).write.mode("append").parquet(landed)
        log = metrics_stream(spark, landed, ev.schema)
        log = log.select(F.col("user_id").alias("run"), "ts", "event_id", F.col("value").alias("eval_loss"))
        rows = monitor(log, out)
    return rows


def divergence_resumed(spark, sf):
    from ..streaming.scans import divergence_scan

    return _resumed(spark, sf, "divergence-resumed", lambda log, path: divergence_scan(log, tie="event_id", path=path))


def cost_meter_resumed(spark, sf):
    from ..streaming.scans import cost_scan

    return _resumed(spark, sf, "cost-resumed", lambda log, path: cost_scan(log, path=path))


def divergence_chunks(spark, sf):
    """Chunks of four steps, so that every run spans several of them."""
    from ..operators.monitor import divergence

    d = divergence(_metrics(spark, sf), chunk_steps=4)
    return d.select("run", "step", "eval_loss", "best_loss", "is_bad", "bad_streak", "should_stop")


def stop_steps(spark, sf):
    from ..operators.monitor import divergence
    from ..operators.monitor import stop_steps as stops

    return stops(divergence(_metrics(spark, sf)))


def cost_meter_batch(spark, sf):
    from ..operators.monitor import cost_meter

    return cost_meter(_metrics(spark, sf)).select("run", "step", "elapsed_hours", "cost")


def cost_meter_stream(spark, sf):
    from ..streaming.scans import cost_scan

    return cost_scan(_events_stream(spark, sf))


def best_checkpoint(spark, sf):
    from ..operators.monitor import best_checkpoint as best

    return best(_metrics(spark, sf))


DOC_JSON_SCHEMA = "doc_id long, text string, lang_value string, source string, n_chars long"


def _landed_documents(spark, sf) -> str:
    """Documents landed as JSONL files, one directory per language."""
    from ..session import scratch_path

    root = scratch_path(spark, "landed-documents")
    docs = _docs(spark, sf).withColumn("lang_value", F.col("lang"))
    docs.write.mode("overwrite").partitionBy("lang").json(root)
    return root


def ingest_new_files(spark, sf):
    """Files of every language but "en" are new; the "en" ones are in the manifest."""
    from ..session import scratch_path
    from ..sources import ingest
    from ..sources.tables import file_listing

    root = _landed_documents(spark, sf)
    manifest = scratch_path(spark, "manifest")
    ingest.commit(file_listing(spark, f"{root}/lang=en", "*.json"), manifest)
    new = ingest.new_files(spark, root, manifest, "*.json")
    rows = ingest.read_new(spark, new, DOC_JSON_SCHEMA)
    return rows.select("doc_id", F.col("lang_value").alias("lang"))


def ingest_alternating(spark, sf):
    """Files land in three parts and are taken by a batch run, a stream and a batch run; each file once."""
    from ..session import scratch_path
    from ..sources import versioned

    landed, root = scratch_path(spark, "alternating"), scratch_path(spark, "versioned")
    docs = _docs(spark, sf).withColumn("lang_value", F.col("lang"))
    for turn in range(3):
        docs.filter(F.pmod("doc_id", F.lit(3)) == turn).write.mode("append").partitionBy("lang").json(landed)
        if turn == 1:
            versioned.stream_folder(spark, landed, root, DOC_JSON_SCHEMA, f"{root}-checkpoint", "*.json")
        else:
            versioned.ingest_folder(spark, landed, root, DOC_JSON_SCHEMA, "*.json")
    entries = versioned.manifest(spark, root).select(F.col("path").alias("_file"), "commit")
    rows = versioned.read_folder(spark, root, DOC_JSON_SCHEMA).join(entries, "_file")
    return rows.select("doc_id", F.col("lang_value").alias("lang"), "commit")


def ingest_stream_files(spark, sf):
    from ..sources import ingest
    from ..streaming.monitors import run_available

    root = _landed_documents(spark, sf)
    stream = ingest.ingest_stream(spark, root, DOC_JSON_SCHEMA, "*.json")
    return run_available(stream.select("doc_id", F.col("lang_value").alias("lang")), "ingest-stream")


# ---------------------------------------------------------------------------
# Builders over a stream, the prepare pipeline, a user encoder over Arrow
# ---------------------------------------------------------------------------


def stream_records(spark, sf):
    """code_writer over a file stream of the documents table (stateless builder)."""
    from ..streaming.monitors import run_available

    docs = _docs(spark, sf)
    stream = spark.readStream.schema(docs.schema).parquet(f"{sf.rstrip('/')}/document[s].parquet")
    return run_available(B.code_writer(fx.instructions(stream)), "stream-records")


def _streamed_chats(spark, sf, builder) -> DataFrame:
    """A chat builder over the log of turns, which lands in three parts by time; the stream goes on after each."""
    from ..session import scratch_path
    from ..streaming.chats import assemble

    log = fx.chat_turns(_conv(spark, sf))
    third, two_thirds = log.select(F.percentile_approx(F.col("ts").cast("timestamp"), [1 / 3, 2 / 3])).first()[0]
    t, landed, out = F.col("ts").cast("timestamp"), scratch_path(spark, "turns-log"), scratch_path(spark, "chats")
    for ended, part in enumerate((t <= third, (t > third) & (t <= two_thirds), t > two_thirds)):
        log.filter(part).write.mode("append").parquet(landed)
        turns = spark.readStream.schema(log.schema).parquet(landed)
        rows = assemble(turns, builder, quiet="10 minutes", path=out, ended=ended == 2)
    return rows


def stream_chats(spark, sf):
    """static_reviewer over a stream of turns; conversations are closed by time, the last ones by the end of the log."""
    return _chat_summary(_streamed_chats(spark, sf, lambda chats: B.static_reviewer(chats, keywords=O.REVIEW_QUERY_KEYWORDS)))


def stream_optimizations(spark, sf):
    """performance_optimizer over the same stream."""
    return _streamed_chats(spark, sf, lambda chats: B.performance_optimizer(chats, groups=O.OPT_QUERY_GROUPS))


def prepare_blocks(spark, sf):
    """The whole prepare pipeline (render → split → encode → pack) for code_writer."""
    from ..operators.recipes import recipe_for
    from .training_set import prepare

    train, _ = prepare(code_writer_records(spark, sf), recipe_for("code_writer"), max_len=PACK_LEN)
    return train.select(
        "block_id",
        F.md5(F.array_join("input_ids", ",")).alias("ids_md5"),
        F.md5(F.array_join("labels", ",")).alias("labels_md5"),
        F.size(F.filter("labels", lambda x: x == -100)).cast("long").alias("separators"),
        F.size("attention_mask").cast("long").alias("mask_len"),
    )


def hash_split(spark, sf):
    return order.hash_split(code_writer_records(spark, sf), "id", fixed.EVAL_FRACTION, fixed.SEED).select("id", "split")


def plain_chat_template():
    """A user chat template: the plain rendering, as a template of a tokenizer would give it."""

    def template(messages):
        return "\n".join(f"<|{m['role'] or 'user'}|>\n{m['content'] or ''}" for m in messages)

    return template


def chat_template_text(spark, sf):
    from ..operators.recipes import recipe_for, render

    recs = B.static_reviewer(fx.chats(_conv(spark, sf)), keywords=O.REVIEW_QUERY_KEYWORDS)
    return render(recs, recipe_for("static_reviewer"), chat_template=plain_chat_template).select("id", "text")


def _vocabulary(spark, sf) -> DataFrame:
    """The words that stand in the documents twice at least, as a stored table; id 0 is for all others."""
    from ..operators.vocabulary import build_vocabulary
    from ..session import scratch_path

    path = scratch_path(spark, "vocabulary")
    build_vocabulary(_docs(spark, sf), "text", min_count=O.VOCAB_MIN_COUNT).write.parquet(path)
    return spark.read.parquet(path)


def vocab_build(spark, sf):
    from ..operators.vocabulary import build_vocabulary

    return build_vocabulary(_docs(spark, sf), "text")


def _vocab_rows(tokens: DataFrame) -> DataFrame:
    return tokens.select(
        "doc_id",
        F.size("input_ids").cast("long").alias("n_tokens"),
        F.size(F.filter("input_ids", lambda i: i == 0)).cast("long").alias("n_unknown"),
        F.md5(F.array_join("input_ids", ",")).alias("ids_md5"),
    )


def vocab_tokens(spark, sf):
    from ..operators.vocabulary import encode_words

    return _vocab_rows(encode_words(_docs(spark, sf), _vocabulary(spark, sf), "doc_id"))


def vocab_tokens_joined(spark, sf):
    """A vocabulary too large to broadcast, and pieces of a few words."""
    from ..operators.vocabulary import encode_words

    return _vocab_rows(encode_words(_docs(spark, sf), _vocabulary(spark, sf), "doc_id", max_broadcast=0, piece_words=64))


def word_length_encoder():
    """A user encoder: one id per whitespace-separated word (its length).

    Stands in for a vocabulary tokenizer (none ships offline); what matters is
    the path: Python encoder, Arrow batches, one encoder per task.
    """

    def encode(texts):
        return [[len(w) for w in t.split()] for t in texts]

    return encode


def arrow_encoder_tokens(spark, sf):
    from ..operators.tokenize import encode_with

    docs = _docs(spark, sf).select(F.col("doc_id").alias("id"), "text")
    tok = encode_with(docs, word_length_encoder, "text", 4096)
    return tok.select(
        "id",
        F.size("input_ids").cast("long").alias("n_tokens"),
        F.md5(F.array_join("input_ids", ",")).alias("ids_md5"),
    )


# ---------------------------------------------------------------------------
# Registry: query name → callable(spark, sf_dir)
# ---------------------------------------------------------------------------

QUERIES: dict[str, Query] = {
    "code_writer_records": code_writer_records,
    "test_pairs_capped": test_pairs_capped,
    "test_pairs_json": test_pairs_json,
    "test_pairs_joined": test_pairs_joined,
    "review_chats": review_chats,
    "lang_filtered_pairs": lang_filtered_pairs,
    "optimization_records": optimization_records,
    "docstring_strip": docstring_strip,
    "docs_records": docs_records,
    "rank_by_group": rank_by_group,
    "pack_by_group": pack_by_group,
    "shuffle_rank": shuffle_rank,
    "sample_n": sample_n,
    "train_eval_split": train_eval_split,
    "split_stats": split_stats,
    "instruction_text": instruction_text,
    "chat_text": chat_text,
    "recipe_join": recipe_join,
    "build_all": build_all,
    "custom_roles_text": custom_roles_text,
    "source_fallback": source_fallback,
    "dataset_stats": dataset_stats,
    "jsonl_roundtrip": jsonl_roundtrip,
    "validation_report": validation_report,
    "validation_counts": validation_counts,
    "validate_files": validate_files,
    "validate_files_first": validate_files_first,
    "validate_files_counts": validate_files_counts,
    "split_column": split_column,
    "fallback_builder": fallback_builder,
    "cached_dir": cached_dir,
    "jsonl_rejects": jsonl_rejects,
    "write_status": write_status,
    "write_status_failing": write_status_failing,
    "prepare_from_jsonl": prepare_from_jsonl,
    "prepare_all_roles": prepare_all_roles,
    "prepare_eval_file": prepare_eval_file,
    "byte_tokens": byte_tokens,
    "pack_positions": pack_positions,
    "pack_stats": pack_stats,
    "pack_blocks": pack_blocks,
    "collated_batches": collated_batches,
    "divergence_batch": divergence_batch,
    "divergence_chunks": divergence_chunks,
    "divergence_stream": divergence_stream,
    "divergence_resumed": divergence_resumed,
    "divergence_keyed": divergence_keyed,
    "cost_meter_batch": cost_meter_batch,
    "cost_meter_stream": cost_meter_stream,
    "cost_meter_resumed": cost_meter_resumed,
    "best_checkpoint": best_checkpoint,
    "ingest_new_files": ingest_new_files,
    "ingest_stream": ingest_stream_files,
    "stream_records": stream_records,
    "stream_chats": stream_chats,
    "stream_optimizations": stream_optimizations,
    "prepare_blocks": prepare_blocks,
    "arrow_encoder_tokens": arrow_encoder_tokens,
    "hash_split": hash_split,
    "chat_template_text": chat_template_text,
    "vocab_build": vocab_build,
    "vocab_tokens": vocab_tokens,
    "vocab_tokens_joined": vocab_tokens_joined,
    "stop_steps": stop_steps,
    "ingest_alternating": ingest_alternating,
}
