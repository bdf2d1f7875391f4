"""Keyed stateful monitors over a metrics stream (Structured Streaming).

``groupBy(run).applyInPandasWithState`` keeps, per run, the state the batch
windows rebuild from history: (best loss, bad counter, rows seen) for the
divergence monitor and the start time for the cost meter. Rows of a run are
sorted by time inside each micro-batch; runs are assumed to arrive in time
order across micro-batches (one writer per run's log).

With ``idle_timeout_ms`` a run's state is dropped once the event-time
watermark passes its last row by that long, so finished runs free their
state; rows later than the watermark are then late data and dropped.

Results are written with ``availableNow`` to a table beside the stream
checkpoint; a call with the same ``path`` resumes there, and nothing passes
through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import fixed
from ..session import scratch_path, ship_package

DIVERGENCE_OUT = T.StructType(
    [
        T.StructField("run", T.LongType()),
        T.StructField("step", T.LongType()),
        T.StructField("eval_loss", T.DoubleType()),
        T.StructField("best_loss", T.DoubleType()),
        T.StructField("is_bad", T.BooleanType()),
        T.StructField("bad_streak", T.LongType()),
        T.StructField("should_stop", T.BooleanType()),
    ]
)
DIVERGENCE_STATE = T.StructType(
    [T.StructField("best", T.DoubleType()), T.StructField("bad", T.LongType()), T.StructField("seen", T.LongType())]
)
COST_OUT = T.StructType(
    [
        T.StructField("run", T.LongType()),
        T.StructField("step", T.LongType()),
        T.StructField("elapsed_hours", T.DoubleType()),
        T.StructField("cost", T.DoubleType()),
    ]
)
COST_STATE = T.StructType([T.StructField("start_us", T.LongType()), T.StructField("seen", T.LongType())])


def _epoch_us(ts: str) -> F.Column:
    """Microseconds since the epoch of a wall-clock (timestamp_ntz) value."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))


def _with_idle_timeout(src: DataFrame, idle_timeout_ms: int | None):
    """Event-time column + watermark for state eviction (time-zone free:
    the watermark column and the timeouts both derive from ``_us``)."""
    if not idle_timeout_ms:
        return src, GroupStateTimeout.NoTimeout
    src = src.withColumn("_event", F.timestamp_micros("_us")).withWatermark(
        "_event", f"{int(idle_timeout_ms)} milliseconds"
    )
    return src, GroupStateTimeout.EventTimeTimeout


def _touch(state: GroupState, rows: pd.DataFrame, idle_timeout_ms: int | None) -> None:
    if idle_timeout_ms and len(rows):
        state.setTimeoutTimestamp(int(rows["_us"].max()) // 1000 + int(idle_timeout_ms))


def _rows(pdfs: Iterator[pd.DataFrame], *by: str) -> pd.DataFrame:
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return pd.DataFrame()
    return pd.concat(frames, ignore_index=True).sort_values(list(by), kind="stable")


def divergence_stream(
    metrics: DataFrame,
    threshold: float = fixed.DIVERGENCE_THRESHOLD,
    patience: int = fixed.DIVERGENCE_PATIENCE,
    run: str = "run",
    ts: str = "ts",
    loss: str = "eval_loss",
    idle_timeout_ms: int | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Streaming twin of ``operators.monitor.divergence`` (step = arrival rank).

    ``tie`` names the column that orders rows of one time; without it they come as they arrive.

    ``idle_timeout_ms``: drop a run's state once the event-time watermark
    passes its last row by that much (rows later than the watermark are then
    dropped as late data). Without it, state is kept for every run.
    """

    order = [ts, *([tie] if tie else [])]

    def update(key, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        best, bad, seen = (None, 0, 0)
        if state.exists:
            best, bad, seen = state.get
        out = []
        rows = _rows(pdfs, *order)
        pairs = zip(rows[loss].tolist(), rows["_null"].tolist()) if len(rows) else []
        for value, missing in pairs:
            seen += 1
            if missing:  # pandas shows a null double as NaN: use the flag
                continue
            v = float(value)
            prev = best
            if best is None or v < best:
                best, bad = v, 0
                flag = False
            elif v > best * threshold:
                bad += 1
                flag = True
            else:
                bad = 0
                flag = False
            out.append((key[0], seen, v, prev, flag, bad, bad >= patience))
        state.update((best, bad, seen))
        _touch(state, rows, idle_timeout_ms)
        if out:
            yield pd.DataFrame(out, columns=[f.name for f in DIVERGENCE_OUT.fields])

    ship_package(metrics.sparkSession)
    src = metrics.select(
        metrics[run].cast("long").alias("run"), *order, loss, F.isnull(loss).alias("_null"), _epoch_us(ts).alias("_us")
    )
    src, timeout = _with_idle_timeout(src, idle_timeout_ms)
    return src.groupBy("run").applyInPandasWithState(update, DIVERGENCE_OUT, DIVERGENCE_STATE, "append", timeout)


def cost_stream(
    metrics: DataFrame,
    price: float = fixed.GPU_HOUR_PRICE,
    run: str = "run",
    ts: str = "ts",
    idle_timeout_ms: int | None = None,
) -> DataFrame:
    """Streaming twin of ``operators.monitor.cost_meter`` (start = first row)."""

    def update(key, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        start, seen = (None, 0)
        if state.exists:
            start, seen = state.get
        rows = _rows(pdfs, "_us")
        out = []
        for us in rows["_us"].tolist() if len(rows) else []:
            seen += 1
            if start is None:
                start = int(us)
            hours = (int(us) - start) / 3.6e9
            out.append((key[0], seen, hours, hours * price))
        state.update((start, seen))
        _touch(state, rows, idle_timeout_ms)
        if out:
            yield pd.DataFrame(out, columns=[f.name for f in COST_OUT.fields])

    ship_package(metrics.sparkSession)
    src = metrics.select(metrics[run].cast("long").alias("run"), _epoch_us(ts).alias("_us"))
    src, timeout = _with_idle_timeout(src, idle_timeout_ms)
    return src.groupBy("run").applyInPandasWithState(update, COST_OUT, COST_STATE, "append", timeout)


def run_available(
    stream: DataFrame,
    name: str,
    spark: SparkSession | None = None,
    path: str | None = None,
    timeout_s: float | None = None,
) -> DataFrame:
    """Process everything available now into a parquet table and return that
    table as a batch DataFrame.

    ``path`` holds the table and the checkpoint: a later call with the same path
    goes on where this one ended. Without it a new folder in the shared one is
    used, for runs that are not to be continued. With ``timeout_s`` a query that
    is still running by then is stopped and reported; its checkpoint stays."""
    spark = spark or stream.sparkSession
    base = path or scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/_checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(f"{base}/data")
    )
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {name} did not finish within {timeout_s} s")
    if query.exception():
        raise RuntimeError(str(query.exception()))
    return spark.read.parquet(f"{base}/data")


def metrics_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int = 1000
) -> DataFrame:
    """A metrics log (parquet files under ``path`` or matching a glob) as a stream.

    A backlog is read in micro-batches of ``files_per_trigger`` files, which
    bounds the rows of a run that meet in one task."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
