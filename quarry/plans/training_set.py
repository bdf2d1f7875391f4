"""Prepare one role's records for training: render → split → encode → pack.

``prepare(records, recipe)`` returns (train, eval) DataFrames. The eval side
is an optional second source (a DataFrame, or a JSONL path used only when it
exists) or else the first ceil(f × n) rows of the repeatable order; the train side is packed into fixed-length blocks when
the recipe says so (eval is never packed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators import order, pack, recipes, tokenize
from ..session import materialize, store
from ..sources.jsonl import CHAT_SCHEMA, INSTRUCTION_SCHEMA, read_numbered
from ..sources.tables import has_files


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def render_records(records: DataFrame, recipe: dict, key="id", chat_template=None) -> DataFrame:
    return recipes.render(records, recipe, chat_template=chat_template).select(*_keys(key), "text")


def prepare_path(spark: SparkSession, path: str, recipe: dict, **options) -> tuple[DataFrame, DataFrame]:
    """``prepare`` from a JSONL file or folder; a record's key is its file and line."""
    return prepare(read_numbered(spark, path, record_schema(recipe)), recipe, ["file", "line"], **options)


def record_schema(recipe: dict):
    return CHAT_SCHEMA if recipe["format"] == "chat" else INSTRUCTION_SCHEMA


def prepare(
    records: DataFrame,
    recipe: dict,
    key="id",
    eval_records: DataFrame | None = None,
    eval_path: str | None = None,
    eval_fraction: float = fixed.EVAL_FRACTION,
    seed: int = fixed.SEED,
    encoder_factory=None,
    eos_id: int | None = None,
    max_len: int | None = None,
    chat_template=None,
    slices: int | None = None,
    keep: str | None = None,
) -> tuple[DataFrame | list[DataFrame], DataFrame]:
    """(train, eval) of one role. With ``slices`` train is a list of at most that many DataFrames, to be used one after the
    other: the texts that the packing of bytes shuffles are then on disk a slice at a time. ``keep`` names a folder for the
    rendered texts, which the caller discards after the last use of the results (else they are checkpointed)."""
    L = int(max_len or recipe["max_seq_length"])
    if eval_records is None and eval_path:
        # An external eval file is used only when it exists; otherwise split.
        if has_files(records.sparkSession, eval_path):
            eval_records = read_numbered(records.sparkSession, eval_path, record_schema(recipe))
            if not {"file", "line"} <= set(_keys(key)):
                named = F.concat_ws(":", "file", "line")
                eval_records = eval_records.withColumns({k: named for k in _keys(key)})
    text = render_records(records, recipe, key, chat_template)
    if eval_records is not None:
        train, ev = text, render_records(eval_records, recipe, key, chat_template)
    else:
        # Split, lengths, blocks and the held rows each read the texts: records are read and rendered once for all.
        if encoder_factory is None:
            # Ids are bytes, at most L of them: no more of a text is kept.
            text = text.withColumn("text", F.substring(F.col("text").cast("binary"), F.lit(1), F.lit(L)))
        split = order.split(store(text, keep) if keep else materialize(text), key, eval_fraction, seed)
        train = split.filter(F.col("split") == "train").drop("split")
        ev = split.filter(F.col("split") == "eval").drop("split")

    def encode(df: DataFrame) -> DataFrame:
        if encoder_factory is None:
            return tokenize.byte_encode(df, "text", L)
        return tokenize.encode_with(df, encoder_factory, "text", L)

    if recipe.get("packing") and encoder_factory is None and slices:
        return pack.pack_bytes_slices(train, key, L, slices, "text", tokenize.eos_id(eos_id), seed), encode(ev)
    if not recipe.get("packing"):
        blocks = encode(train)
    elif encoder_factory is None:
        blocks = pack.pack_bytes(train, key, L, "text", tokenize.eos_id(eos_id), seed)
    else:
        # A user encoder is the costly step: checkpoint its output once.
        # Labels are a copy of the ids until separators are masked: packing makes them itself.
        blocks = pack.pack(encode(train).drop("labels"), key, L, tokenize.eos_id(eos_id), seed, materialize_input=True)
    return [blocks] if slices else blocks, encode(ev)


def prepare_all(
    records: DataFrame,
    recipe_df: DataFrame,
    key="id",
    role: str = "role",
    eval_fraction: float = fixed.EVAL_FRACTION,
    seed: int = fixed.SEED,
    eos_id: int | None = None,
    slices: int | None = None,
    keep: str | None = None,
) -> tuple[DataFrame | list[DataFrame], DataFrame, DataFrame]:
    """Every role at once: (packed blocks, train rows of roles that are not packed, eval rows).

    ``records`` hold the roles' fields beside a ``role`` column, as ``build_all`` and a JSONL read of all roles give
    them. The recipe of a row gives its format, its length and whether it is packed; ranks, splits and blocks are made
    per role in one set of jobs, and the rendered texts are written once for all of them. The blocks of a role have its
    own length (``max_seq_length``). ``key`` is unique within a role.
    With ``slices`` the blocks are a list of DataFrames; ``keep`` is a folder for the texts (see ``prepare``)."""
    keys = _keys(key)
    rendered = recipes.render_by_recipe(recipes.with_recipe(records, recipe_df, role))
    # Ids are bytes, at most a role's length of them: no more of a text is kept.
    cut = F.substring(F.col("text").cast("binary"), F.lit(1), F.col("max_seq_length")).alias("text")
    rows = rendered.select(role, *keys, "max_seq_length", "packing", cut)
    rows = store(rows, keep) if keep else materialize(rows)
    rows = order.split(rows, keys, eval_fraction, seed, [role])
    longest = int(recipe_df.agg(F.max("max_seq_length")).first()[0])
    ids = tokenize.byte_encode(rows, "text", longest)
    cut = F.slice("input_ids", F.lit(1), F.col("max_seq_length"))
    ids = ids.withColumns({"input_ids": cut, "attention_mask": F.slice("attention_mask", F.lit(1), F.col("max_seq_length")), "labels": cut})
    train, held = F.col("split") == "train", F.col("split") == "eval"
    columns = [role, *keys, "input_ids", "attention_mask", "labels"]
    to_pack = rows.filter(train & F.col("packing"))
    if slices:
        blocks = pack.pack_bytes_slices(to_pack, keys, "max_seq_length", slices, "text", tokenize.eos_id(eos_id), seed, [role])
    else:
        blocks = pack.pack_bytes(to_pack, keys, "max_seq_length", "text", tokenize.eos_id(eos_id), seed, [role])
    return blocks, ids.filter(train & ~F.col("packing")).select(*columns), ids.filter(held).select(*columns)
