"""Role recipes: the role → format/fields/limits table, lookup and rendering.

The recipe table has one row per role (a handful), so it is broadcast with a
size bound that does not grow with the data. A record whose role has no
recipe fails the job in the same pass, naming the sorted valid roles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.render import render_chat, render_instruction

RECIPE_SCHEMA = T.StructType(
    [
        T.StructField("role", T.StringType(), False),
        T.StructField("format", T.StringType(), False),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("max_seq_length", T.IntegerType(), False),
        T.StructField("packing", T.BooleanType(), False),
    ]
)
FORMATS = ("instruction", "chat")
MAX_BROADCAST_ROLES = 100_000


def recipe_rows(overrides: dict[str, dict] | None = None) -> list[tuple]:
    """The recipe table; ``overrides`` changes known roles and adds new ones."""
    rows, known = [], {r[0] for r in fixed.RECIPES}
    base = [*fixed.RECIPES, *[(r, "instruction", fixed.NEW_ROLE_MAX_LEN, False) for r in (overrides or {}) if r not in known]]
    for role, fmt, max_len, packing in base:
        fmt = (overrides or {}).get(role, {}).get("format", fmt)
        fields = dict(fixed.INSTRUCTION_FIELDS if fmt == "instruction" else fixed.CHAT_FIELDS)
        o = (overrides or {}).get(role, {})
        rows.append(
            (role, fmt, o.get("fields", fields), int(o.get("max_seq_length", max_len)),
             bool(o.get("packing", packing)))
        )
    return rows


def recipes(spark: SparkSession, overrides: dict[str, dict] | None = None) -> DataFrame:
    return spark.createDataFrame(recipe_rows(overrides), RECIPE_SCHEMA)


def recipe_for(role: str, overrides: dict[str, dict] | None = None) -> dict:
    """One role's recipe (plan-time); unknown role → error listing valid ones."""
    table = {r[0]: r for r in recipe_rows(overrides)}
    if role not in table:
        raise ValueError(f"Unknown agent '{role}'. Available: {', '.join(sorted(table))}")
    _, fmt, fields, max_len, packing = table[role]
    return {"role": role, "format": fmt, "fields": fields, "max_seq_length": max_len, "packing": packing}


def with_recipe(df: DataFrame, recipe_df: DataFrame, role_col: str = "role") -> DataFrame:
    """Attach format/fields/limits by role (broadcast: one row per role).

    A role without a recipe fails the job in the same pass, with the sorted
    list of valid roles (no extra job over the data). A recipe naming an
    unknown format is rejected before anything runs.
    """
    table = recipe_df.collect()  # one row per role
    bad = [r.format for r in table if r.format not in FORMATS]
    if bad:
        raise ValueError(f"Unknown format: {bad[0]}")
    valid = ", ".join(sorted(r.role for r in table))
    side = recipe_df.withColumnRenamed("role", role_col).withColumn("_known", F.lit(True))
    joined = df.join(F.broadcast(side) if len(table) <= MAX_BROADCAST_ROLES else side, role_col, "left")
    unknown = F.raise_error(F.concat(F.lit("Unknown agent '"), F.col(role_col).cast("string"), F.lit(f"'. Available: {valid}")))
    # In every attached column, so the error survives column pruning whichever of them is read.
    for c in ("format", "fields", "max_seq_length", "packing"):
        joined = joined.withColumn(c, F.when(F.col("_known").isNull(), unknown).otherwise(F.col(c)))
    return joined.drop("_known")


def remap(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Placeholder → source column (default: the placeholder's own name)."""
    return df.select(*[F.col(fields.get(k, k)).alias(k) for k in fields])


def render(df: DataFrame, recipe: dict, out: str = "text", chat_template=None) -> DataFrame:
    """Render one role's records to prompt text (plan-time format dispatch).

    Chat records use ``chat_template`` (a factory of messages → text, run in
    Arrow batches) when given, else the plain "<|role|>" rendering.
    """
    fmt, fields = recipe["format"], recipe["fields"]
    if fmt == "instruction":
        c = [F.col(fields.get(k, k)) for k in ("instruction", "input", "output")]
        return df.withColumn(out, render_instruction(*c))
    if fmt == "chat":
        messages = F.col(fields.get("messages", "messages"))
        if chat_template is not None:
            from ..functions.render import chat_template_udf
            from ..session import ship_package

            ship_package(df.sparkSession)
            return df.withColumn(out, chat_template_udf(chat_template)(messages))
        return df.withColumn(out, render_chat(messages))
    raise ValueError(f"Unknown format: {fmt}")


def _field(df: DataFrame, name_col: Column) -> Column:
    """Value of the string column whose name is given per row."""
    value = F.lit(None).cast("string")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            value = F.when(name_col == f.name, F.col(f.name)).otherwise(value)
    return value


def _messages(df: DataFrame, name_col: Column) -> Column | None:
    """The conversation column whose name is given per row (null when no column is one)."""
    value = None
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType) and {"role", "content"} <= set(t.elementType.names):
            other = value if value is not None else F.lit(None).cast(t)
            value = F.when(name_col == f.name, F.col(f.name)).otherwise(other)
    return value


def render_by_recipe(df: DataFrame, out: str = "text") -> DataFrame:
    """Render records of many roles at once (after ``with_recipe``).

    Instruction fields and the conversation of chat roles are looked up
    through the recipe's field map.
    """
    inst = render_instruction(
        *[_field(df, F.coalesce(F.col("fields")[k], F.lit(k))) for k in ("instruction", "input", "output")]
    )
    messages = _messages(df, F.coalesce(F.col("fields")["messages"], F.lit("messages")))
    chat_col = render_chat(messages) if messages is not None else F.lit(None).cast("string")
    return df.withColumn(
        out, F.when(F.col("format") == "instruction", inst).when(F.col("format") == "chat", chat_col)
    )
