"""Files of a folder as one table, each file once and in its latest version, taken by batch and stream runs alike.

Under ``root`` are ``data/batch=<id>`` (the rows of the files that a run took, with their file) and
``manifest/batch=<id>`` (path, length, modification time and number of the commit of these files). A run writes its
rows first and its manifest last, both by replacing the folders of its own batch id: rows without a manifest are not
seen, and a run or a stream's batch that is repeated replaces what it wrote. The next commit number is one more than
the greatest in the manifest.

The manifest's latest entry of a path wins. A file whose length or time has changed is taken again, and the rows of
its earlier version are no longer read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import file_listing, has_files, resolve_uri

FILE, LENGTH, TIME = "_file", "_length", "_time"
MANIFEST = "path string, length long, time timestamp, commit long"
#: Latest files that are sent to all tasks; beyond that rows meet them by their file.
MAX_BROADCAST_FILES = 500_000


def _bare(c) -> F.Column:
    """One spelling of a path: %-escapes undone, "file:///x" and "file:/x" alike."""
    plain = F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(F.coalesce(plain, c), "^([a-z0-9]+):/+", "$1:/")


def _folder(root: str, kind: str) -> str:
    return f"{resolve_uri(root).rstrip('/')}/{kind}"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All entries: (path, length, time, commit, batch)."""
    where = _folder(root, "manifest")
    schema = T.StructType([*T._parse_datatype_string(MANIFEST).fields, T.StructField("batch", T.StringType())])
    if not has_files(spark, where, "*.parquet"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(where)


def latest(entries: DataFrame) -> DataFrame:
    """The entry of each path that counts."""
    last = F.max_by(F.struct("length", "time", "commit", "batch"), F.col("commit")).alias("x")
    return entries.groupBy("path").agg(last).select("path", "x.*")


def _not_taken(files: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows of files (path, length, time, …) whose version is not the latest that was taken."""
    known = latest(entries).select(*[F.col(c).alias(f"_k_{c}") for c in ("path", "length", "time")])
    same = (F.col("path") == F.col("_k_path")) & (F.col("length") == F.col("_k_length")) & (F.col("time") == F.col("_k_time"))
    return files.join(known, same, "left_anti")


def _commit(spark: SparkSession, rows: DataFrame, files: DataFrame, root: str, batch: str, number: int) -> None:
    """Write the rows, then the manifest of one batch id; both replace what the same id wrote before."""
    rows.write.mode("overwrite").parquet(f"{_folder(root, 'data')}/batch={batch}")
    entries = files.select("path", "length", "time", F.lit(number).cast("long").alias("commit"))
    entries.write.mode("overwrite").parquet(f"{_folder(root, 'manifest')}/batch={batch}")


def _next(entries: DataFrame) -> int:
    return int(entries.agg(F.coalesce(F.max("commit"), F.lit(0))).first()[0]) + 1


def ingest_folder(spark: SparkSession, src_dir: str, root: str, schema: T.StructType | str, glob: str = "*.jsonl", fmt: str = "json") -> int:
    """Take the files that are new or changed since the last run; the number of them.

    The listing is compared with the manifest; only folders with such files are read, and of them only their rows."""
    entries = manifest(spark, root)
    listing = file_listing(spark, src_dir, glob).select(_bare(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("time"))
    number = _next(entries)
    batch = f"run-{number}"
    fresh = _folder(root, "listing") + f"/batch={batch}"
    _not_taken(listing, entries).write.mode("overwrite").parquet(fresh)  # one listing for the rows and for the manifest
    new = spark.read.parquet(fresh)
    n = new.count()
    if not n:
        return 0
    reader = spark.read.format(fmt).schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    rows = with_file(reader.load(resolve_uri(src_dir)))
    wanted = new.select(F.col("path").alias(FILE))
    side = F.broadcast(wanted) if n <= MAX_BROADCAST_FILES else wanted
    # Spark's scan reads a file whole; a row group or line of another file is read and left out here.
    _commit(spark, rows.join(side, FILE, "left_semi").drop(LENGTH, TIME), new, root, batch, number)
    return n


def with_file(rows: DataFrame) -> DataFrame:
    """Rows of a file source with their file, its length and its time."""
    m = F.col("_metadata")
    return rows.withColumns({FILE: _bare(m["file_path"]), LENGTH: m["file_size"], TIME: m["file_modification_time"]})


def stream_folder(
    spark: SparkSession, src_dir: str, root: str, schema: T.StructType | str, checkpoint: str, glob: str = "*.jsonl", fmt: str = "json", files_per_trigger: int = 10_000
) -> None:
    """Take what has landed as a stream (``availableNow``) into the same table.

    A micro-batch is one commit under an id of the stream and the batch, so a batch that is played again replaces
    itself; files that a batch run took before are left out by the manifest."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    rows = with_file(reader.option("maxFilesPerTrigger", files_per_trigger).load(resolve_uri(src_dir)))
    query = (
        rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda batch, n: take_batch(batch, n, root, checkpoint)).start()
    )
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def take_batch(rows: DataFrame, number: int, root: str, name: str) -> None:
    """Commit one micro-batch (rows of ``with_file``); the same number of the same stream is the same commit."""
    import hashlib

    spark = rows.sparkSession
    batch = f"stream-{hashlib.md5(name.encode()).hexdigest()[:12]}-{number}"
    entries = manifest(spark, root)
    mine = entries.filter(F.col("batch") == batch)
    others = entries.filter(F.col("batch") != batch)
    # A replayed batch keeps its number, so that it does not come to stand before a later commit.
    before = mine.agg(F.max("commit")).first()[0]
    files = rows.select(F.col(FILE).alias("path"), F.col(LENGTH).alias("length"), F.col(TIME).alias("time")).distinct()
    earlier = others if before is None else others.filter(F.col("commit") < int(before))
    new = files.transform(lambda x: _not_taken(x, earlier)).checkpoint()
    wanted = new.select(F.col("path").alias(FILE))
    side = F.broadcast(wanted) if new.count() <= MAX_BROADCAST_FILES else wanted
    _commit(spark, rows.join(side, FILE, "left_semi").drop(LENGTH, TIME), new, root, batch, _next(others) if before is None else int(before))


def read_folder(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """The rows of the latest version of every file that was taken, with their file (``_file``)."""
    fields = T._parse_datatype_string(schema).fields if isinstance(schema, str) else schema.fields
    held = T.StructType([*fields, T.StructField(FILE, T.StringType()), T.StructField("batch", T.StringType())])
    where = _folder(root, "data")
    if not has_files(spark, where, "*.parquet"):
        return spark.createDataFrame([], held).drop("batch")
    wins = latest(manifest(spark, root)).select(F.col("path").alias(FILE), "batch")
    n = wins.count()
    rows = spark.read.schema(held).parquet(where)
    return rows.join(F.broadcast(wins) if n <= MAX_BROADCAST_FILES else wins, [FILE, "batch"], "left_semi").drop("batch")
