"""Dataset validation as a report DataFrame.

Checks, in order: the path exists and files are non-empty (V1); optional
SHA-256 of a file (V2); every non-blank line is JSON (V3) and an object with
the required keys, present-with-null counting as present (V4); at least one
record per file (V5). The report holds every failure; ``first_error``
reproduces the fail-fast message of the first one (V6).

Line numbers are exact and count blank lines. They are derived without a
window over the data: a text split is read by one task in order, so within
(file, split start) the ids of ``monotonically_increasing_id`` are
consecutive; a table with a row per split gives each split's first line and
is joined by broadcast up to MAX_BROADCAST_SPLITS rows.

The JSON test is strict by default: Python's own parser decides, because no
Spark built-in accepts exactly what it accepts (``{"a":1} x`` passes
``from_json``; ``NaN`` fails ``try_parse_json``). In a report most lines never
reach it (``failing_lines``): a pattern of the JSON grammar proves them to be
objects in the JVM, and only lines it cannot decide (damaged, not an object,
nested deeper than PROVEN_DEPTH, NaN, very long integers) go to an Arrow-batched
pandas UDF. ``strict=False`` uses ``json_object_keys`` (JVM only) instead.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean, strip_ws
from ..session import materialize, ship_package
from ..sources.tables import files_or_none, resolve_uri

#: A digest needs the whole file as one array of bytes.
MAX_DIGEST_BYTES = 2_000_000_000
MAX_BROADCAST_SPLITS = 500_000
REPORT_SCHEMA = "file string, line long, issue string, detail string"
PARSE_TYPE = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("keys", T.ArrayType(T.StringType())),
    ]
)


class ValidationError(Exception):
    pass


#: Levels of objects and arrays that the pattern of the JSON grammar follows; a deeper line is left to the parser.
PROVEN_DEPTH = 4


def json_object_pattern(depth: int = PROVEN_DEPTH) -> str:
    """Java pattern of the lines that are one JSON object of at most `depth` levels; it accepts nothing else.

    All loops are possessive: they run without recursion and never go back, so a line of any length costs one pass.
    Integers are held to 300 digits, as the parser refuses very long ones.
    """
    ws = r"[ \t\n\r]*+"
    plain = r'[^"\\\x00-\x1f]*+'
    string = rf'"{plain}(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{{4}}){plain})*+"'
    scalar = rf"{string}|-?+(?:0|[1-9][0-9]{{0,299}}+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+|true|false|null"

    def several(item: str, end: str) -> str:
        return rf"{ws}(?:{item}{ws}(?:,{ws}(?!{end})|(?={end})))*+{end}"

    def an_object(value: str) -> str:
        return r"\{" + several(rf"{string}{ws}:{ws}(?:{value})", r"\}")

    value = scalar
    for _ in range(depth - 1):
        value = rf"{scalar}|{an_object(value)}|\[{several(f'(?:{value})', chr(92) + ']')}"
    return rf"\A{an_object(value)}\z"


def _parse_one(s: str):
    try:
        obj = json.loads(s)
    except (ValueError, RecursionError) as exc:
        return ("invalid_json", str(exc), None)
    if not isinstance(obj, dict):
        return ("not_object", type(obj).__name__, None)
    return ("ok", None, list(obj.keys()))


def _parse_batch(values: pd.Series) -> pd.DataFrame:
    rows = [_parse_one(v) for v in values]
    return pd.DataFrame(rows, columns=["status", "error", "keys"])


# Marked non-deterministic only so the optimizer does not copy the call into
# both the filter and the projection above it (it would parse every line twice).
parse_json_strict = F.pandas_udf(_parse_batch, PARSE_TYPE).asNondeterministic()


def _parse_fast(value) -> F.Column:
    keys = F.json_object_keys(value)
    status = (
        F.when(keys.isNotNull(), F.lit("ok"))
        .when(F.json_array_length(value).isNotNull(), F.lit("not_object"))
        .otherwise(F.lit("invalid_json"))
    )
    return F.struct(status.alias("status"), F.lit(None).cast("string").alias("error"), keys.alias("keys"))


def check_lines(lines: DataFrame, required: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """Per non-blank line: status (ok / invalid_json / not_object / missing_fields).

    ``lines`` has a ``value`` column (raw line); other columns pass through.
    """
    if strict:
        ship_package(lines.sparkSession)
    body = lines.filter(clean("value") != F.lit(""))
    v = strip_ws(F.col("value"))
    parsed = body.withColumn("_p", parse_json_strict(v) if strict else _parse_fast(v))
    req = F.array(*[F.lit(k) for k in (required or [])]).cast("array<string>")
    missing = F.array_except(req, F.coalesce(F.col("_p.keys"), F.array().cast("array<string>")))
    status = F.when((F.col("_p.status") == "ok") & (F.size(missing) > 0), F.lit("missing_fields")).otherwise(
        F.col("_p.status")
    )
    detail = F.when(status == "missing_fields", F.concat(F.lit("missing "), F.to_json(missing))).otherwise(
        F.col("_p.error")
    )
    return parsed.withColumn("status", status).withColumn("detail", detail).drop("_p")


def failing_lines(lines: DataFrame, required: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """The rows of ``check_lines`` whose status is not ok.

    Lines that the pattern proves to be objects with all required keys end in the JVM; the parser decides the rest."""
    if strict:
        v = strip_ws(F.col("value"))
        proven = v.rlike(json_object_pattern())
        if required:
            held = F.when(proven, F.json_object_keys(v))
            proven = F.size(F.array_except(F.array(*[F.lit(k) for k in required]), held)) == 0
        lines = lines.filter(~F.coalesce(proven, F.lit(False)))
    return check_lines(lines, required, strict).filter(F.col("status") != "ok")


def validate_lines(
    lines: DataFrame, required: Sequence[str] | None = None, strict: bool = True
) -> tuple[DataFrame, DataFrame]:
    """For (file, line, value) rows: (failures, per-file counts).

    failures: file, line, check, detail. counts: file, records (valid lines).
    """
    failures = failing_lines(lines, required, strict).select(
        "file", "line", F.col("status").alias("issue"), "detail"
    )
    # Written to the shared folder: the report and the counts read it, the parser runs once a line.
    failures = materialize(failures)
    non_blank = lines.groupBy("file").agg(F.count_if(clean("value") != F.lit("")).alias("non_blank"))
    return failures, _valid_counts(non_blank, failures)


def _valid_counts(non_blank: DataFrame, failures: DataFrame) -> DataFrame:
    """Valid records per file: non-blank lines (counted in the JVM) less the failing ones."""
    failed = failures.groupBy("file").agg(F.count(F.lit(1)).alias("failed"))
    return non_blank.join(failed, "file", "left").select(
        "file", (F.col("non_blank") - F.coalesce("failed", F.lit(0))).cast("long").alias("records")
    )


def numbered_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(raw lines with file/_block/_mid, per-split table with _first/_before/_non_blank)."""
    raw = spark.read.format("text").option("recursiveFileLookup", "true").load(resolve_uri(path)).select(
        _norm_path(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"),
        "value",
    )
    splits = raw.groupBy("file", "_block").agg(
        F.min("_mid").alias("_first"),
        F.count(F.lit(1)).alias("_n"),
        F.count_if(clean("value") != F.lit("")).alias("_non_blank"),
    )
    w = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return raw, splits


def _norm_path(c) -> F.Column:
    """One spelling per path: "file:///x" and "file:/x" → "file:/x", %-escapes (scans have them, listings not) undone."""
    plain = F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(F.coalesce(plain, c), "^file:/+", "file:/")


def with_line(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows of ``numbered_lines`` with their exact line number (from 1, blank lines counted).

    ``splits`` is materialised: it is counted, and broadcast when it is small, so that the texts do not move."""
    side = splits.select("file", "_block", "_first", "_before")
    side = F.broadcast(side) if splits.count() <= MAX_BROADCAST_SPLITS else side
    return rows.join(side, ["file", "_block"]).withColumn(
        "line", (F.col("_before") + F.col("_mid") - F.col("_first") + 1).cast("long")
    )


def validate_files(
    spark: SparkSession,
    path: str,
    required: Sequence[str] | None = None,
    sha256: str | DataFrame | None = None,
    strict: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(report, counts) of a JSONL file or of all files under a directory.

    report: every failure (file, line, issue, detail), not the first only. counts: file, records (valid lines).
    ``sha256`` is the digest every file must have, or a table (file, sha256); files not in it are not checked.
    Two passes over the text: one in the JVM counts lines per split, one parses each line once; the split counts
    and the failures go to the shared folder and all else is derived from them.
    A digest reads a file as one value, so a longer file than that can hold gets the issue ``too_large``.
    """
    empty = spark.createDataFrame([], REPORT_SCHEMA)
    found = files_or_none(spark, path)
    if found is None:
        missing = spark.createDataFrame([(path, None, "missing", f"no such path: {path}")], REPORT_SCHEMA)
        return missing, spark.createDataFrame([], "file string, records long")
    listing = found.select("path", "length")
    scanned = listing.select(_norm_path(F.col("path")).alias("file"), "length")
    # The scan leaves out files of no bytes; only the file index, which the driver holds anyway, has them.
    listed = spark.createDataFrame([(p,) for p in listing.inputFiles()], "file string")
    listed = listed.select(_norm_path(F.col("file")).alias("file"))
    report = _file_issue(listed.join(scanned, "file", "left_anti"), "empty", F.lit("file has no bytes"))
    if sha256 is not None:
        report = report.unionByName(_digest_failures(found, scanned, sha256))
    raw, splits = numbered_lines(spark, path)
    splits = materialize(splits)
    bad = materialize(failing_lines(raw, required, strict).drop("value"))
    report = report.unionByName(
        with_line(bad, splits).select("file", "line", F.col("status").alias("issue"), "detail")
    )
    counts = _valid_counts(splits.groupBy("file").agg(F.sum("_non_blank").alias("non_blank")), bad)
    none = scanned.join(counts, "file", "left").filter(F.coalesce("records", F.lit(0)) == 0)
    report = report.unionByName(_file_issue(none, "no_records", F.lit("file has no valid record")))
    return report.unionByName(empty), counts


def _file_issue(files: DataFrame, issue: str, detail: F.Column) -> DataFrame:
    """Report rows that concern whole files."""
    return files.select("file", F.lit(None).cast("long").alias("line"), F.lit(issue).alias("issue"), detail.alias("detail"))


def file_digests(found: DataFrame) -> DataFrame:
    """(file, actual): SHA-256 of each file of ``read_files`` of a length that one value can hold."""
    small = found.filter(F.col("length") <= MAX_DIGEST_BYTES)
    return small.select(_norm_path(F.col("path")).alias("file"), F.sha2(F.col("content"), 256).alias("actual"))


def _digest_failures(found: DataFrame, scanned: DataFrame, expected: str | DataFrame) -> DataFrame:
    if isinstance(expected, DataFrame):
        wanted = expected.select(_norm_path(F.col("file")).alias("file"), "sha256")
    else:
        wanted = scanned.select("file", F.lit(expected).alias("sha256"))
    pairs = wanted.join(file_digests(found), "file").filter(F.col("actual") != F.lower("sha256"))
    wrong = _file_issue(pairs, "sha256", F.concat(F.lit("expected "), F.col("sha256"), F.lit(", got "), F.col("actual")))
    large = scanned.join(wanted, "file").filter(F.col("length") > MAX_DIGEST_BYTES)
    return wrong.unionByName(_file_issue(large, "too_large", F.col("length").cast("string")))


def validate(
    spark: SparkSession,
    path: str,
    required: Sequence[str] | None = None,
    sha256: str | DataFrame | None = None,
    strict: bool = True,
) -> DataFrame:
    """The report of ``validate_files`` alone."""
    return validate_files(spark, path, required, sha256, strict)[0]


def _severity() -> F.Column:
    """Order in which a fail-fast check meets the issues."""
    order = ["missing", "empty", "too_large", "sha256"]
    last = F.when(F.col("issue") == "no_records", len(order) + 1).otherwise(len(order))
    for i, name in enumerate(order):
        last = F.when(F.col("issue") == name, i).otherwise(last)
    return last


def first_failures(report: DataFrame) -> DataFrame:
    """Per file the failure a fail-fast check would stop at."""
    first = F.min_by(F.struct("line", "issue", "detail"), F.struct(_severity(), "line")).alias("first")
    return report.groupBy("file").agg(first).select("file", "first.*")


def first_error(report: DataFrame) -> str | None:
    """The failure the fail-fast check would stop at (one row to the driver)."""
    row = report.select(
        F.min_by(F.struct("file", "detail", "issue", "line"), F.struct(_severity(), "file", "line")).alias("first")
    ).first()
    if row is None or row.first is None:
        return None
    f = row.first
    return f"{f.issue} at {f.file}:{f.line}: {f.detail}" if f.line is not None else f"{f.issue}: {f.detail}"


def raise_on_error(report: DataFrame) -> None:
    msg = first_error(report)
    if msg:
        raise ValidationError(msg)


def record_count(spark: SparkSession, path: str, required: Sequence[str] | None = None) -> int:
    """Number of valid records; raises ValidationError on any failure."""
    report, counts = validate_files(spark, path, required)
    raise_on_error(report)
    return int(counts.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0])
