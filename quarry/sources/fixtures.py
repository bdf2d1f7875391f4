"""Source tables derived from the driver tables.

The builders read six source shapes (instruction triples, unit-test
problems, problems with test lists, chats, security pairs, functions). The
given tables stand in for them by fixed rules; every rule is a projection
(or, for chats, one grouping per conversation), so the work grows with the
tables and nothing is sampled or filtered away here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_line


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def instructions(documents: DataFrame) -> DataFrame:
    """id, instruction = first line, input = source, output = text."""
    return documents.select(
        F.col("doc_id").alias("id"),
        first_line("text").alias("instruction"),
        F.col("source").alias("input"),
        F.col("text").alias("output"),
    )


def unit_tests(documents: DataFrame, as_structs: bool = True) -> DataFrame:
    """id, question = first line, code_ground_truth = text, unit_tests = lines."""
    lines = F.split(F.col("text"), "\n", -1)
    tests = F.transform(lines, lambda x: F.struct(x.alias("code"))) if as_structs else lines
    return documents.select(
        F.col("doc_id").alias("id"),
        first_line("text").alias("question"),
        F.col("text").alias("code_ground_truth"),
        tests.alias("unit_tests"),
    )


def problems(documents: DataFrame) -> DataFrame:
    """id, text = first line, code = text, test_list = lines."""
    return documents.select(
        F.col("doc_id").alias("id"),
        first_line("text").alias("text"),
        F.col("text").alias("code"),
        F.split(F.col("text"), "\n", -1).alias("test_list"),
    )


def chat_role(conversations: DataFrame) -> F.Column:
    """Rename some roles so role normalisation has work: user → human, assistant → tool."""
    k = F.col("conv_id") + F.col("turn")
    return (
        F.when((F.col("role") == "user") & (k % 3 == 0), F.lit("human"))
        .when((F.col("role") == "assistant") & (k % 5 == 0), F.lit("tool"))
        .otherwise(F.col("role"))
    )


def chats(conversations: DataFrame) -> DataFrame:
    """id, messages: the turns of a conversation in turn order.

    One group per conversation: a conversation is the record unit, so its
    size is that of one output row.
    """
    turns = conversations.select(
        "conv_id", "turn", F.struct(chat_role(conversations).alias("role"), F.col("text").alias("content")).alias("m")
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "m"))).alias("ms"))
    return grouped.select(F.col("conv_id").alias("id"), F.transform("ms", lambda x: x["m"]).alias("messages"))


def chat_turns(conversations: DataFrame) -> DataFrame:
    """id, turn, role, content, ts: a log of turns; conversations begin a minute apart, their turns follow by the second."""
    seconds = F.coalesce(F.col("conv_id"), F.lit(0)) * 60 + F.coalesce(F.col("turn"), F.lit(0))
    return conversations.select(
        F.col("conv_id").alias("id"),
        "turn",
        chat_role(conversations).alias("role"),
        F.col("text").alias("content"),
        F.timestamp_seconds(seconds).cast("timestamp_ntz").alias("ts"),
    )


def security_pairs(documents: DataFrame) -> DataFrame:
    """id, lang, vulnerability = source, question = first line, chosen = text, rejected = reversed text."""
    return documents.select(
        F.col("doc_id").alias("id"),
        F.col("lang"),
        F.col("source").alias("vulnerability"),
        first_line("text").alias("question"),
        F.col("text").alias("chosen"),
        F.reverse(F.col("text")).alias("rejected"),
    )


def docstring_quote(doc_id: F.Column) -> F.Column:
    return F.when(doc_id % 3 == 0, F.lit('r"""')).when(doc_id % 3 == 1, F.lit("'''")).otherwise(F.lit('"""'))


def functions(documents: DataFrame) -> DataFrame:
    """id, code, docstring, func_name: each document wrapped as a function.

    code = "def f_<id>():" + [a line with an inline triple quote for ids ≡ 1
    mod 4, which is not an opener] + the text as a docstring + a return line.
    """
    d = F.col("doc_id")
    q = docstring_quote(d)
    close = F.substring(q, -3, 3)
    lead = F.when(d % 4 == 1, F.concat(F.lit('\n    x = """'), F.col("lang"), F.lit('"""'))).otherwise(F.lit(""))
    code = F.concat(
        F.lit("def f_"), d.cast("string"), F.lit("():"), lead,
        F.lit("\n    "), q, F.col("text"), close,
        F.lit("\n    return "), F.col("n_chars").cast("string"), F.lit("\n"),
    )
    return documents.select(
        d.alias("id"),
        code.alias("code"),
        first_line("text").alias("docstring"),
        F.concat(F.lit("f_"), d.cast("string")).alias("func_name"),
    )


def metrics(events: DataFrame) -> DataFrame:
    """run = user_id, step = rank of (ts, event_id) within the run, ts, eval_loss = value.

    Steps come from ``order.ordinal_rank``, not a window per run, so one
    user holding a large share of the events does not land in one task.
    """
    from ..operators.order import ordinal_rank

    base = events.select(
        F.col("user_id").alias("run"), F.col("ts"), F.col("event_id"), F.col("value").alias("eval_loss")
    )
    ranked = ordinal_rank(base, ["run"], ["ts", "event_id"], out="step")
    return ranked.select("run", "step", "ts", "eval_loss")
