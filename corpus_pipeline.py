"""From raw documents to packed training sequences, in five stages over the whole table.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return
the columns of documents. ``run`` writes every stage as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import langid, line_dedup, mix, pack, simhash
from quarry.llm.common import free_name, table
from quarry.session import scratch_path


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the profiles know; rejected: null texts, texts without a letter or a known n-gram.

    Repeated rows stay or go together; an empty table, or one without languages to learn, gives no rows."""
    out = free_name(docs, "_language")
    x = langid.language_of_documents(docs, out=out)
    # The score is 0 only where every n-gram is out of place for every language.
    return x.filter((F.col(f"{out}.lang_pred") != "und") & (F.col(f"{out}.score") > 0)).select(*_columns(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that other documents repeat; n_chars follows the text. Every document stays.

    Null texts become empty, as do texts that lose all lines; rows with a null id lose repeated lines. An empty table
    stays empty."""
    out = free_name(docs, "_lines")
    x = line_dedup.deduplicate_lines(docs, out=out)
    now = {"text": F.col(f"{out}.text"), "n_chars": F.length(f"{out}.text").cast("long")}
    return x.select(*[now.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest doc_id, null ids last.

    Null and empty texts are one class. An empty table stays empty."""
    return simhash.keep_one_of_each_class(docs, words_per_shingle=3, max_bits=3)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights in training order: a row per copy taken, the last of a source cut at its target.

    A null source is a source; texts without words are not taken. An empty table stays empty."""
    x = mix.mixed_rows(docs)
    return x.withColumn("n_chars", F.length("text").cast("long")).select(*_columns(docs))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every row with its sequence of at most 4096 tokens and its place there.

    Null and empty texts are one piece of the end id; repeated rows are packed each. An empty table stays empty."""
    return pack.pack_documents(docs, capacity=4096, end_id=1)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("mix_to_weights", mix_stage),
    ("best_fit_packing", pack_stage),
]

#: The stages of language profiles, fingerprints and packing cannot be said in SQL; tests/llm/test_pipeline.py checks
#: each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
