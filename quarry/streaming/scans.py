"""Monitors over a metrics stream as prefix scans, with a table of states between micro-batches.

A micro-batch goes through the same scans as the batch monitors (``operators.monitor``): steps are ranked by ranges and
scanned in chunks, so a run that holds a third of the log is spread over many tasks. What a later batch needs of a run is
a few numbers: the best loss, the bad streak and the rows seen, or the start and the rows seen. They stand in
``state/batch=<n>``, one whole table a batch; the results in ``data/batch=<n>``. Batch n reads the table of the batch before
it and replaces what it wrote itself, so a batch that is played again after a failure changes nothing.

Runs come in time order from batch to batch (one writer per run's log); within a batch in any order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..operators import monitor
from ..operators.order import ordinal_rank
from ..session import materialize, scratch_path

DIVERGENCE_STATE = "run long, best double, bad long, seen long, last timestamp_ntz"
COST_STATE = "run long, start timestamp_ntz, seen long, last timestamp_ntz"


def _read_state(spark: SparkSession, base: str, schema: str, before: int) -> DataFrame:
    """The table that the last batch before this one wrote."""
    held = spark.read.schema(T.StructType([*T._parse_datatype_string(schema).fields, T.StructField("batch", T.LongType())])).parquet(f"{base}/state")
    earlier = held.filter(F.col("batch") < before)
    last = earlier.agg(F.max("batch")).first()[0]
    return earlier.filter(F.col("batch") == (-1 if last is None else last)).drop("batch")


def _with_state(rows: DataFrame, state: DataFrame) -> DataFrame:
    """rows with their run's state (null where the run is new); null runs are a run."""
    side = state.select(*[F.col(c).alias(f"_s_{c}") for c in state.columns])
    side = F.broadcast(side) if state.count() <= monitor.SMALL_TABLE_ROWS else side
    return rows.join(side, F.col("run").eqNullSafe(F.col("_s_run")), "left").drop("_s_run", "_s_last")


def _numbered(batch: DataFrame, state: DataFrame, order: list[str]) -> DataFrame:
    """The batch's rows with their step: the rows of their run seen before, and their rank in the batch."""
    ranked = ordinal_rank(batch, ["run"], order, out="_rank")
    x = _with_state(ranked, state)
    return materialize(x.withColumn("step", F.col("_rank") + F.coalesce("_s_seen", F.lit(0))).drop("_rank", "_s_seen"))


def _kept(state: DataFrame, idle: str | None) -> DataFrame:
    """The states to keep: with ``idle``, an interval, those of runs that had a row in it before the newest one."""
    if not idle:
        return state
    newest = state.agg(F.max("last")).first()[0]
    return state.filter(F.col("last") >= F.lit(newest).cast("timestamp_ntz") - F.expr(f"interval {idle}"))


def _merged(state: DataFrame, seen: DataFrame, schema: str, idle: str | None) -> DataFrame:
    """The state table after a batch: its runs anew, the others as they were."""
    names = [f.name for f in T._parse_datatype_string(schema).fields]
    runs = seen.select(F.col("run").alias("_run"))
    others = state.join(runs, F.col("run").eqNullSafe(F.col("_run")), "left_anti")
    return _kept(materialize(others.select(*names).unionByName(seen.select(*names))), idle)


def divergence_batch(batch: DataFrame, state: DataFrame, order: list[str], threshold: float, patience: int, idle: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(results of a micro-batch, states after it)."""
    x = _numbered(batch, state, order)
    before = x.select("run", F.col("_s_best").alias("best"), F.col("_s_bad").alias("bad")).distinct()
    d = monitor.divergence(x.select("run", "step", "eval_loss"), threshold, patience, state=before)
    d = materialize(d.select("run", "step", "eval_loss", "best_loss", "is_bad", "bad_streak", "should_stop"))
    after = x.groupBy("run").agg(
        F.max("step").alias("seen"), F.max("ts").alias("last"), F.first("_s_best").alias("was"), F.first("_s_bad").alias("bad_before"),
        F.min("eval_loss").alias("least"), F.min_by("eval_loss", F.when(F.col("eval_loss").isNotNull(), F.col("step"))).alias("first"),
    )
    streaks = d.groupBy("run").agg(F.max_by("bad_streak", "step").alias("streak")).withColumnRenamed("run", "_run")
    after = after.join(streaks, F.col("run").eqNullSafe(F.col("_run")), "left")
    nan = F.lit(float("nan"))
    stays = F.isnan(F.coalesce("was", "first"))  # a run whose first loss is no number never has a best one
    best = F.when(stays, nan).otherwise(F.least("was", "least"))
    after = after.withColumns({"best": best, "bad": F.coalesce("streak", "bad_before", F.lit(0)).cast("long")})
    return d, _merged(state, after, DIVERGENCE_STATE, idle)


def cost_batch(batch: DataFrame, state: DataFrame, order: list[str], price: float, idle: str | None = None) -> tuple[DataFrame, DataFrame]:
    x = _numbered(batch, state, order)
    starts = x.groupBy("run").agg(F.min("ts").alias("_first"), F.max("step").alias("seen"), F.max("ts").alias("last"), F.first("_s_start").alias("_was"))
    after = materialize(starts.select("run", F.coalesce("_was", "_first").alias("start"), "seen", "last"))
    out = _with_state(x.select("run", "step", "ts"), after)
    hours = F.timestamp_diff("MICROSECOND", F.col("_s_start"), F.col("ts")).cast("double") / F.lit(3.6e9)
    out = out.select("run", "step", hours.alias("elapsed_hours"), (hours * F.lit(float(price))).alias("cost"))
    return out, _merged(state, after, COST_STATE, idle)


def _run(stream: DataFrame, name: str, schema: str, step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]], path: str | None) -> DataFrame:
    spark = stream.sparkSession
    base = path or scratch_path(spark, name)
    fields = T._parse_datatype_string(schema)
    spark.createDataFrame([], fields).write.mode("ignore").parquet(f"{base}/state/batch=-1")

    def take(batch: DataFrame, n: int) -> None:
        rows, state = step(batch, materialize(_read_state(spark, base, schema, n)))
        rows.write.mode("overwrite").parquet(f"{base}/data/batch={n}")
        state.write.mode("overwrite").parquet(f"{base}/state/batch={n}")

    query = stream.writeStream.option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).foreachBatch(take).start()
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    return spark.read.parquet(f"{base}/data").drop("batch")


def divergence_scan(
    metrics: DataFrame,
    threshold: float = fixed.DIVERGENCE_THRESHOLD,
    patience: int = fixed.DIVERGENCE_PATIENCE,
    tie: str | None = None,
    path: str | None = None,
    idle: str | None = None,
) -> DataFrame:
    """The divergence monitor over what is available of a stream (run, ts, eval_loss[, tie]); the results so far.

    ``tie`` orders rows of one run and time, else their loss does. A call with the same ``path`` goes on where the last one
    ended. ``idle`` (an interval, such as "7 days") drops the state of runs without a row for so long before the newest
    one; a run that comes back then starts anew."""
    order = ["ts", tie or "eval_loss"]
    src = metrics.select(F.col("run").cast("long").alias("run"), F.col("ts").cast("timestamp_ntz").alias("ts"), "eval_loss", *([tie] if tie else []))
    return _run(src, "divergence-scan", DIVERGENCE_STATE, lambda b, s: divergence_batch(b, s, order, threshold, patience, idle), path)


def cost_scan(metrics: DataFrame, price: float = fixed.GPU_HOUR_PRICE, path: str | None = None, idle: str | None = None) -> DataFrame:
    """The cost meter over what is available of a stream (run, ts); as ``divergence_scan``."""
    src = metrics.select(F.col("run").cast("long").alias("run"), F.col("ts").cast("timestamp_ntz").alias("ts"))
    return _run(src, "cost-scan", COST_STATE, lambda b, s: cost_batch(b, s, ["ts"], price, idle), path)
