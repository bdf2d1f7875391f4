"""Incremental ingest of new files.

Batch: list the source directory without reading content (``binaryFile``
metadata), anti-join the listing with a manifest table on (path, length) and
read only the new files; ``commit`` appends them to the manifest. A file whose
size changed is ingested again. Full paths are kept, so files with the same
name in two directories are both ingested, and every new JSONL file is read
(not only the first).

Stream: a file-source stream over the directory with a checkpoint; the
checkpoint's file log plays the manifest and ``availableNow`` processes what
has arrived since the last run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import file_listing, has_files, resolve_uri

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
    ]
)


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    if has_files(spark, manifest, "*.parquet"):
        return spark.read.parquet(resolve_uri(manifest))
    return spark.createDataFrame([], MANIFEST_SCHEMA)


def new_files(spark: SparkSession, src_dir: str, manifest: str, glob: str = "*.jsonl") -> DataFrame:
    """Files under ``src_dir`` not yet in the manifest with the same size."""
    listing = file_listing(spark, src_dir, glob)
    if listing.limit(1).count() == 0:
        raise FileNotFoundError(f"No objects found at {src_dir}")
    synced = read_manifest(spark, manifest).select("path", "length")
    return listing.join(synced, ["path", "length"], "left_anti")


def commit(new: DataFrame, manifest: str) -> None:
    new.select("path", "length", "modificationTime").write.mode("append").parquet(resolve_uri(manifest))


def read_new(spark: SparkSession, new: DataFrame, schema: T.StructType | str, fmt: str = "json") -> DataFrame:
    """Read the content of the new files.

    Their folders are read and the rows of other files left out by a join on
    the file path, so the paths never gather on the driver; only the folders
    do, of which there are few."""
    dirs = [r[0] for r in new.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1)).distinct().collect()]
    if not dirs:
        return spark.createDataFrame([], schema)
    rows = spark.read.format(fmt).schema(schema).load(dirs)
    decoded = F.expr("url_decode(replace(_metadata.file_path, '+', '%2B'))")
    bare = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    rows = rows.withColumn("_file", bare(decoded))
    wanted = new.select(bare(F.expr("url_decode(replace(path, '+', '%2B'))")).alias("_file"))
    return rows.join(wanted, "_file", "left_semi").drop("_file")


def ingest_stream(spark: SparkSession, src_dir: str, schema: T.StructType | str, glob: str = "*.jsonl") -> DataFrame:
    """New files of ``src_dir`` as a stream (use with a checkpointed sink)."""
    return (
        spark.readStream.format("json").schema(schema).option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true").load(resolve_uri(src_dir))
    )


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path"))
