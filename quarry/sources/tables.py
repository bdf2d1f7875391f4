"""Named sources, URI resolution and fallback chains.

* ``resolve_uri``: scheme allow-list ("", "file", "s3", cluster folders); anything else is an
  error naming the supported schemes. ``s3://`` is read through Hadoop's
  ``s3a`` filesystem, ``file://`` works as a local path.
* ``read_source``: a table by path and optional split: a sub-directory, or a value of the column that its folders
  name (``split=train/``), which prunes the other folders in the plan.
* ``read_first_available``: try candidates in order and return the first
  whose path and schema resolve. Resolution is eager (plan time); the lazy
  part of a DataFrame cannot fall back.
* ``list_files``: a metadata-only listing (``binaryFile`` without content).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed


#: Schemes of the shared folders of a cluster; the engine writes there and reads its own files back.
CLUSTER_SCHEMES = ("hdfs", "viewfs", "s3a")


def resolve_uri(uri: str) -> str:
    scheme = urlparse(uri).scheme
    supported = (*fixed.SUPPORTED_SCHEMES, *CLUSTER_SCHEMES)
    if scheme not in supported:
        raise ValueError(f"no reader for URI scheme '{scheme}'. Supported: {list(supported)}")
    if scheme == "s3":
        return "s3a://" + uri[len("s3://"):]
    return uri


def read_source(
    spark: SparkSession, uri: str, split: str | None = None, fmt: str = "parquet", split_column: str | None = None, **options: str
) -> DataFrame:
    path = resolve_uri(uri).rstrip("/")
    if split and split_column:
        table = spark.read.format(fmt).options(**options).load(path)
        if split_column not in table.columns:
            raise FileNotFoundError(f"{uri} has no column {split_column}")
        rows = table.filter(F.col(f"`{split_column}`").cast("string") == split).drop(split_column)
        if rows.isEmpty():  # the filter prunes folders, so where there are none no file is read
            raise FileNotFoundError(f"{uri} has no {split_column}={split}")
        return rows
    if split:
        path = f"{path}/{split}"
    return spark.read.format(fmt).options(**options).load(path)


def read_first_available(
    spark: SparkSession,
    candidates: Sequence[tuple | Callable[[], DataFrame]],
) -> tuple[int, DataFrame]:
    """Return (index, DataFrame) of the first candidate that resolves.

    A candidate is ``(uri, split, fmt[, split_column])`` or a zero-argument callable (for a
    fallback that needs a different builder). Errors of all candidates are
    reported when none resolves.
    """
    errors = []
    for i, cand in enumerate(candidates):
        try:
            df = cand() if callable(cand) else read_source(spark, *cand)
            df.schema  # resolve the path and schema now
            return i, df
        except (PySparkException, Py4JJavaError, FileNotFoundError, ValueError) as exc:
            errors.append(f"{cand!r}: {exc}")
    raise FileNotFoundError("no source available: " + "; ".join(errors))


def read_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """A row per file under ``path``; the content is read only where a plan uses it."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(resolve_uri(path))


def file_listing(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """path, length, modificationTime of the files under ``path`` (content not read)."""
    return read_files(spark, path, glob, recursive).select("path", "length", "modificationTime")


def files_or_none(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame | None:
    """``read_files`` of a path that holds a file of some bytes, else None; the path is listed once."""
    try:
        found = read_files(spark, path, glob)
        # One row at most reaches the driver; a count would run a task for every partition of the files.
        return found if found.select("path").take(1) else None
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def has_files(spark: SparkSession, path: str, glob: str | None = None) -> bool:
    """Whether the listing is non-empty."""
    return files_or_none(spark, path, glob) is not None
