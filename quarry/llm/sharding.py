"""Shards cut from a Hilbert curve over several metadata columns.

Each column is quantised to ``2 ** bits`` cells of about equal rows, the cells of a row give its place on a Hilbert
curve, and the rows in curve order are cut into runs whose numbers of rows differ by one at most; ``files`` runs
make a shard. Neighbours on the curve are alike in every column, so each run covers a small box of all of them and a
filter on any of the columns leaves most files unread.

A narrow pass over (curve index, row hash) finds the exact first row of each run. The rows themselves cross the
network once, to the run that their key falls in, and are written there in curve order; a row's slot is its
run's place in the shard plus its position in the file.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.order import ordinal_rank
from .ann import hilbert
from .common import ready, tasks

DIMENSIONS = ("lang", "source", "n_chars")
#: Bytes of a string that are compared beyond what all strings of its column begin with.
PREFIX_BYTES = 6
#: Bytes looked at for the common beginning.
COMMON_BYTES = 256


# ---- quantising -----------------------------------------------------------------------------------


def _number(c: Column, kind: T.DataType, skip: int) -> Column:
    """A double in the order of the values. Strings: their first bytes after `skip` that all share."""
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        d = c.cast("double") if not isinstance(kind, T.BooleanType) else c.cast("int").cast("double")
        return F.when(F.isnan(d), F.lit(float("inf"))).otherwise(d)
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return c.cast("timestamp").cast("double")
    digits = F.rpad(F.hex(F.substring(c.cast("string").cast("binary"), skip + 1, PREFIX_BYTES)), 2 * PREFIX_BYTES, "0")
    return F.conv(digits, 16, 10).cast("double")


def _is_text(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))


def _shared_bytes(df: DataFrame, names: Sequence[str]) -> dict[str, int]:
    """Length of what all values of each string column begin with: that of their least and greatest value."""
    if not names:
        return {}
    first = [F.substring(F.col(f"`{c}`").cast("string").cast("binary"), 1, COMMON_BYTES) for c in names]
    row = df.agg(*[f(x) for x in first for f in (F.min, F.max)]).first()
    out = {}
    for i, c in enumerate(names):
        a, b = bytes(row[2 * i] or b""), bytes(row[2 * i + 1] or b"")
        out[c] = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return out


def curve_index(df: DataFrame, dimensions: Sequence[str], bits: int) -> Column:
    """Place of a row on the curve. Nulls have the first cell of their column; a column's other cells are cut at its
    quantiles, so a value in a third of the rows has a third of the cells for itself."""
    if not 1 <= bits * len(dimensions) <= 63:
        raise ValueError("bits x dimensions must be 1 to 63")
    kinds = {c: df.schema[c].dataType for c in dimensions}
    shared = _shared_bytes(df, [c for c in dimensions if _is_text(kinds[c])])
    numbers = [_number(F.col(f"`{c}`"), kinds[c], shared.get(c, 0)) for c in dimensions]
    n = 2**bits - 1
    shares = [i / n for i in range(1, n)]
    row = df.agg(*[F.percentile_approx(x, shares) for x in numbers]).first() if shares else [[]] * len(numbers)
    cuts = [np.sort(np.array(x or [], np.float64)) for x in row]

    @F.arrow_udf(T.LongType())
    def place(*columns: pa.Array) -> pa.Array:
        cells = []
        for x, cut in zip(columns, cuts):
            null = np.asarray(pc.is_null(x))
            value = np.asarray(pc.fill_null(x, 0.0))
            cells.append(np.where(null, 0, np.searchsorted(cut, value, side="right") + 1))
        return pa.array(hilbert(np.stack(cells, 1), bits))

    return place(*numbers)


def _row_hash(df: DataFrame) -> Column:
    """Orders rows of one place; equal rows only are equal in it (or, rarely, stand beside each other anyhow)."""
    def plain(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        return F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c

    return F.xxhash64(*[plain(f) for f in df.schema.fields])


# ---- runs -----------------------------------------------------------------------------------------


def _runs(keys: DataFrame, n_rows: int, runs: int) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """(run numbers, their first keys, keys whose rows stand in several runs with their first rank)."""
    ranked = ordinal_rank(keys, [], ["curve", "h"]).withColumn("r", F.col("rank") - 1).select("curve", "h", "r")
    run = F.expr(f"(r * {runs}L) div {n_rows}L")
    before = F.expr(f"((r - 1) * {runs}L) div {n_rows}L")
    firsts = ranked.withColumn("run", run).filter((F.col("r") == 0) | (run != before))
    rows = firsts.orderBy("run").collect()  # one a run
    held = keys.sparkSession.createDataFrame([(r.curve, r.h) for r in rows], "curve long, h long").distinct()
    again = ranked.join(F.broadcast(held), ["curve", "h"]).groupBy("curve", "h").agg(F.min("r").alias("r"), F.max("r").alias("last"))
    tied = [(t.curve, t.h, t.r) for t in again.filter(F.expr(f"(r * {runs}L) div {n_rows}L != (last * {runs}L) div {n_rows}L")).collect()]
    return np.array([r.run for r in rows]), _sortable(np.array([r.curve for r in rows]), np.array([r.h for r in rows])), tied


def _sortable(curve: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Pairs of signed 64-bit numbers as 16 bytes in their order."""
    out = np.empty((len(curve), 2), ">u8")
    for i, x in enumerate((curve, h)):
        out[:, i] = x.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.view("S16")[:, 0]


def write_shards(
    df: DataFrame,
    path: str,
    dimensions: Sequence[str] = DIMENSIONS,
    shards: int = 16,
    bits: int = 8,
    files: int | None = None,
) -> None:
    """Write every row to its shard, a file per run, in curve order; ``read_shards`` reads them back.

    Shards have equal rows up to one. Nulls are values like others (the first cell); null and empty texts, repeated
    rows and rows with equal metadata are dealt like any; rows that are equal in every column are told apart by
    number only, where a cut falls among them. Columns of any name and type are kept. An empty table writes no file.
    ``files`` is the number of runs of a shard, by default enough for every task to have one.
    """
    ready(df)
    spark = df.sparkSession
    runs = shards * (files or -(-tasks(spark) // shards))
    x = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), curve_index(df, dimensions, bits).alias("curve"), _row_hash(df).alias("h")
    )
    n = df.count()
    fields = [T.StructField("rows", T.LongType()), T.StructField("runs", T.LongType()), T.StructField("shards", T.LongType()), T.StructField("dimensions", T.ArrayType(T.StringType()))]
    spark.createDataFrame([(n, runs, shards, list(dimensions))], T.StructType(fields)).coalesce(1).write.mode("overwrite").parquet(f"{path}/_manifest")
    numbers, firsts, tied = _runs(x.select("curve", "h"), n, runs) if n else (np.zeros(0, np.int64), np.zeros(0, "S16"), [])

    @F.arrow_udf(T.IntegerType())
    def run_of(curve: pa.Array, h: pa.Array) -> pa.Array:
        at = np.searchsorted(firsts, _sortable(np.asarray(curve), np.asarray(h)), side="right") - 1
        return pa.array(numbers[at].astype(np.int32))

    run = run_of("curve", "h")
    if tied:
        # Equal rows over a cut are numbered; there are no others in these windows.
        side = spark.createDataFrame(tied, "curve long, h long, tied long")
        x = x.join(F.broadcast(side), ["curve", "h"], "left")
        number = F.row_number().over(Window.partitionBy("curve", "h").orderBy("tied"))
        over = x.filter("tied is not null").withColumn("r", F.col("tied") + number - 1)
        over = over.select("row", "curve", "h", F.expr(f"cast((r * {runs}L) div {n}L as int)").alias("run"))
        x = x.filter("tied is null").select("row", "curve", "h", run.alias("run")).unionByName(over)
    else:
        x = x.withColumn("run", run)
    x = x.withColumn("shard", F.expr(f"cast(run div {runs // shards} as int)"))
    x = x.repartitionById(runs, F.col("run")).sortWithinPartitions("shard", "run", "curve", "h")
    written = x.select("row", "curve", "shard", "run").write.mode("append").option("maxRecordsPerFile", 0).partitionBy("shard", "run")
    written.parquet(f"{path}/data")


def _files(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    schema = T.StructType([T.StructField("row", row), T.StructField("curve", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("run", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{path}/data")


def _placed(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    """(row, place): each row with its shard, slot and place on the curve."""
    m = spark.read.parquet(f"{path}/_manifest").first()  # one row
    x = _files(spark, path, row).select("row", "curve", "shard", "run", F.col("_metadata.row_index").alias("i"))
    # The first rank of run k is k * rows / runs, rounded up.
    first = lambda k: F.expr(f"(({k}) * {m.rows}L + {m.runs - 1}L) div {m.runs}L")
    slot = first("run") + F.col("i") - first(f"shard * {m.runs // m.shards}L")
    return x.select("row", F.struct("shard", slot.cast("long").alias("slot"), "curve").alias("place"))


def read_shards(spark: SparkSession, path: str, row: T.StructType, out: str = "_shard") -> DataFrame:
    """The rows (their schema is `row`) with a column `out`: struct(shard, slot, curve). Filters on the dimensions
    reach the files, whose ranges of values are narrow in all of them."""
    return _placed(spark, path, row).select(*[F.col(f"row.`{c}`") for c in row.names], F.col("place").alias(out))


def run_ranges(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    """(shard, run, rows, least and greatest value of each dimension) per file: what a reader prunes by."""
    m = spark.read.parquet(f"{path}/_manifest").first()
    ends = [f(F.col(f"row.`{c}`")).alias(f"{name}_{c}") for c in m.dimensions for name, f in (("min", F.min), ("max", F.max))]
    return _files(spark, path, row).groupBy("shard", "run").agg(F.count(F.lit(1)).alias("rows"), *ends)


def shard_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write the shards and read from them each document's place: (doc_id, size, text_crc32, law, shard, slot,
    grown_shard). The law is `rows`: the shards' counts differ by one at most, so grown_shard is null."""
    write_shards(df, path, **options)
    x = _placed(df.sparkSession, path, df.schema)
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    return x.select(
        F.col(f"row.`{id_col}`").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "place.shard",
        "place.slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "place.curve",
    )
