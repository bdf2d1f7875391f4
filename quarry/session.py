"""Session and storage helpers.

The library never assumes a machine-local folder on a cluster: anything that
must be materialised (cut lineage, stream checkpoints, written tables) goes
under the shared folder named by ``spark.checkpoint.dir``. Only when the
session has none (tests, local runs) do we pick a local one.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def local_session(master: str = "local[8]", app: str = "quarry", **conf: str) -> SparkSession:
    """A session for tests and local benchmarks (cluster jobs bring their own)."""
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for materialised data: ``spark.checkpoint.dir``.

    Read from the session. A fresh local folder stands in only where the driver
    is the only machine (master local or local[n]); elsewhere an unset folder is
    an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where two passes must see identical partitions (range partitioning
    samples its bounds) or where recomputation would be costly. A reliable
    checkpoint survives executor loss, unlike a local checkpoint.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, path: str) -> DataFrame:
    """Cut lineage with compressed Parquet files in a folder that the caller drops with ``discard``.

    For large texts, where ``materialize`` would take half as much disk again; rows come back in other partitions."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``store`` has made."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints of frames that are out of use.

    It does so once the driver's JVM collects its garbage, which may be long after a phase has ended.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in Python workers (once per application).

    Operators that run Python in tasks (pandas UDFs, applyInPandas, state
    functions, mapInArrow) pickle functions that refer to this package. The
    package is zipped and added with ``addPyFile``, which Spark distributes to
    every executor, so workers do not depend on the driver's working directory.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="quarry-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.join("quarry", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(app)
