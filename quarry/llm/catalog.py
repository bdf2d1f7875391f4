"""Registered queries of this subpackage: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import ann, conversation_repair, dac, divergence_audit, langid, line_dedup, minhash, mix, oracle, pack, pii, secret_scan, sharding, simhash
from .common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=3)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = langid.language_of_documents(table(spark, sf_dir, "documents"))
    return x.select("doc_id", langid.held_out().alias("held_out"), "_language.lang_pred", "_language.score")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = mix.mix(table(spark, sf_dir, "documents"))
    return mix.range_sorted(x, "position", "doc_id").select("doc_id", "size", "source_size", "target", "taken", "position")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack_documents(table(spark, sf_dir, "documents"), capacity=4096, end_id=1)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = line_dedup.deduplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return x.select("doc_id", "_lines.n_lines", "_lines.n_dropped", F.sha2("_lines.text", 256).alias("kept_sha256"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.neighbours_and_classes(table(spark, sf_dir, "documents"))


def op7_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "codes")
    dac.write_documents(table(spark, sf_dir, "documents"), path, end_id=2)
    return dac.read_documents(spark, path)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents")).drop("all_spans")


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit.audit_sources(table(spark, sf_dir, "documents"))


def op12_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), scratch_path(spark, "shards"), shards=16)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_conversations(damaged).withColumnRenamed("conv", "conv_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_language, op3_mix, op4_best_fit_packing, op5_line_dedup, op6_minhash, op7_token_codes, op8_secrets, op9_neighbours, op10_personal_data, op11_divergence_audit, op12_hilbert_shards, op13_conversation_repair, pipeline)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
