"""JSONL scan and sinks.

* ``read_jsonl``: lines are stripped (Unicode whitespace), blank lines are
  skipped and each remaining line is parsed with the given schema. Spark's
  text source splits on ``\\n``, ``\\r\\n`` and ``\\r`` like Python's text mode.
* ``write_jsonl``: one object per line, non-ASCII kept, nulls written as
  ``null``, overwrite; the row count comes from an ``Observation`` of the
  same job (no second pass).
* ``write_roles``: one directory per role (``role=<name>``).
* ``split_jsonl``: good lines as records and bad lines as rejects, in one pass.
* ``read_cached_dir``: every ``*.jsonl`` of a directory; an empty listing is
  an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean, strip_ws
from ..session import materialize
from .tables import has_files, resolve_uri

INSTRUCTION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("instruction", "input", "output")]
)
MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
#: Gzip at its lowest level: a tenth larger, a quarter of the time.
QUICK = {"zlib.compress.level": "BEST_SPEED"}
CHAT_SCHEMA = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))])


def read_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("text")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(resolve_uri(path))


def parse_jsonl(
    lines: DataFrame, schema: T.StructType, strict: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Skip blank lines, parse the rest; ``strict`` fails the job on a line that is no JSON object.

    ``keep`` names columns of ``lines`` that go with the record."""
    body = lines.filter(clean("value") != F.lit(""))
    if strict:
        # The test of the validation report; from_json alone takes trailing text and single quotes.
        from ..operators.integrity import check_lines

        body = check_lines(body)
        bad = F.raise_error(F.concat(F.lit("line is no JSON object: "), F.substring("value", 1, 200)))
        body = body.select(F.when(F.col("status") == "ok", F.col("value")).otherwise(bad).alias("value"), *keep)
        parsed = body.select(*keep, F.from_json(strip_ws(F.col("value")), schema, {"mode": "FAILFAST"}).alias("r"))
    else:
        parsed = body.select(*keep, F.from_json(strip_ws(F.col("value")), schema).alias("r"))
    return parsed.select(*keep, "r.*")


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType = INSTRUCTION_SCHEMA, strict: bool = True
) -> DataFrame:
    return parse_jsonl(read_lines(spark, path), schema, strict)


def read_numbered(
    spark: SparkSession, path: str, schema: T.StructType = INSTRUCTION_SCHEMA, strict: bool = True
) -> DataFrame:
    """Records of a file, or of all files under a folder, with ``file`` and ``line``.

    The two columns are a key: no two records share it, and it is the same in every run, whatever the splits."""
    from ..operators.integrity import numbered_lines, with_line

    raw, splits = numbered_lines(spark, path)
    return parse_jsonl(with_line(raw, materialize(splits)), schema, strict, ["file", "line"])


def split_jsonl(
    spark: SparkSession,
    path: str,
    root: str,
    schema: T.StructType = INSTRUCTION_SCHEMA,
    required: Sequence[str] | None = None,
    strict: bool = True,
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(records, rejects, counts) of a file, or of all files under a folder; one bad line costs that line only.

    Each line is parsed once and written under ``root``, good and bad ones apart; the counts of both are observed in
    that job. records: file, line and the schema's fields, of lines that are JSON objects with the required keys.
    rejects: file, line, value, issue, detail. Blank lines are neither."""
    from ..operators.integrity import check_lines, numbered_lines, with_line

    raw, splits = numbered_lines(spark, path)
    checked = check_lines(with_line(raw, materialize(splits)).select("file", "line", "value"), required, strict)
    ok = F.col("status") == "ok"
    obs = Observation("split_jsonl")
    checked = checked.observe(obs, F.count_if(ok).alias("records"), F.count_if(~ok).alias("rejects"))
    kind = F.when(ok, "record").otherwise("reject").alias("kind")
    checked.select("file", "line", "value", "status", "detail", kind).write.mode("overwrite").partitionBy("kind").parquet(resolve_uri(root))
    written = spark.read.schema("file string, line long, value string, status string, detail string, kind string").parquet(resolve_uri(root))
    good = written.filter("kind = 'record'").select("file", "line", F.from_json(strip_ws(F.col("value")), schema).alias("r"))
    bad = written.filter("kind = 'reject'").select("file", "line", "value", F.col("status").alias("issue"), "detail")
    return good.select("file", "line", "r.*"), bad, {k: int(v) for k, v in obs.get.items()}


def read_cached_dir(
    spark: SparkSession, directory: str, schema: T.StructType = INSTRUCTION_SCHEMA
) -> DataFrame:
    """All ``*.jsonl`` and ``*.json`` files of a directory, the sinks' parts included (error if there are none)."""
    if not has_files(spark, directory, "*.{json,jsonl}"):
        raise FileNotFoundError(f"No JSONL files found in {directory}")
    return parse_jsonl(read_lines(spark, directory, "*.{json,jsonl}"), schema)


def write_jsonl(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "none", mode: str = "overwrite"
) -> int:
    """Write one JSON object per line (a directory of part files); return rows."""
    obs = Observation("write_jsonl")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    sink = observed.write.mode(mode).partitionBy(*partition_by).option("ignoreNullFields", "false")
    sink.options(**QUICK).json(resolve_uri(path), compression=compression)
    return int(obs.get["rows"])


def write_roles(df: DataFrame, root: str, role_col: str = "role") -> int:
    """``<root>/role=<name>/part-*.json``; returns total rows written."""
    obs = Observation("write_roles")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite").partitionBy(role_col).option("ignoreNullFields", "false").json(resolve_uri(root))
    return int(obs.get["rows"])


def to_lines(df: DataFrame, cols: list[str] | None = None, out: str = "line") -> DataFrame:
    """Serialise records to the JSON line the sink writes (nulls kept)."""
    cols = cols or df.columns
    return df.select(
        *[c for c in df.columns if c not in cols],
        F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias(out),
    )
