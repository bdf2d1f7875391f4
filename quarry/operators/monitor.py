"""Training-metric monitors over a metrics log (batch form).

Input rows: (run, step, ts, eval_loss). Rows without a loss are ignored.

* ``divergence``: per run, in step order. A strictly lower loss is a new best
  and resets the counter; a loss above best × threshold is bad (counter + 1,
  stop once the counter reaches ``patience``); anything else resets the
  counter. NaN follows Python's comparisons, not Spark's ordering (where NaN
  is larger than every number): a NaN first loss stays the best forever and
  every comparison with NaN is false.
* ``cost_meter``: elapsed hours since the run's first log row × price.
* ``best_checkpoint``: per run, the earliest step with the lowest loss
  (NaN and null dropped) — a plain aggregate with map-side partials.

No operator puts a whole run into one task. The divergence state is two
prefix scans (running minimum of the loss, running last good row), each done
in two levels: steps are cut into chunks of ``chunk_steps``; a per-chunk
aggregate and a window over the small chunk table give each chunk's prefix,
and the row-level window runs inside a chunk only. A run holding a third of
the log is therefore spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..session import materialize
from .order import join_null_safe

SMALL_TABLE_ROWS = 1_000_000  # broadcast limit for per-run / per-chunk tables


def _join_small(df: DataFrame, small: DataFrame, on, rows: int | None) -> DataFrame:
    """Join a per-key summary (null keys too); broadcast it when its row count is known small."""
    side = F.broadcast(small) if rows is not None and rows <= SMALL_TABLE_ROWS else small
    return join_null_safe(df, side, on)


def divergence(
    metrics: DataFrame,
    threshold: float = fixed.DIVERGENCE_THRESHOLD,
    patience: int = fixed.DIVERGENCE_PATIENCE,
    run: str = "run",
    step: str = "step",
    loss: str = "eval_loss",
    chunk_steps: int = 1 << 16,
    state: DataFrame | None = None,
) -> DataFrame:
    """Adds best_loss (best before this row), is_bad, bad_streak, should_stop.

    ``state`` (run, best, bad) has what earlier rows left of each run that stands in ``metrics``; both null for a new run."""
    m = metrics.filter(F.col(loss).isNotNull()).withColumn("_c", F.floor(F.col(step) / chunk_steps).cast("long"))
    v = F.col(loss)

    # Level 1 — per chunk: minimum loss and row count; per run: the first loss.
    chunks = m.groupBy(run, "_c").agg(F.min(v).alias("_cmin"), F.count(F.lit(1)).alias("_cn"))
    cw = Window.partitionBy(run).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_pmin", F.min("_cmin").over(cw)).withColumn(
        "_pcount", F.coalesce(F.sum("_cn").over(cw), F.lit(0))
    )
    firsts = m.groupBy(run).agg(F.min_by(v, F.col(step)).alias("_first"), F.min(step).alias("_s0"))
    # Written once: the count and the join below read the same few rows.
    chunks = materialize(chunks)
    n_chunks = chunks.count()
    x = _join_small(m, chunks.select(run, "_c", "_pmin", "_pcount"), [run, "_c"], n_chunks)
    x = _join_small(x, firsts, [run], n_chunks)

    # Level 2 — inside a chunk: running minimum before the row, running count.
    w = Window.partitionBy(run, "_c").orderBy(step)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    # Spark's min() skips NaN unless every value is NaN; Python keeps a NaN first loss.
    running = F.least(F.col("_pmin"), F.min(v).over(before))
    nan, earlier = F.lit(float("nan")), F.lit(0)
    best = F.when(F.isnan("_first") & (F.col(step) > F.col("_s0")), nan).otherwise(running)
    if state is not None:
        left = state.select(run, F.col("best").alias("_best0"), F.coalesce("bad", F.lit(0)).alias("_bad0"))
        x = _join_small(x, left, [run], n_chunks)
        best = F.when(F.isnan("_best0"), nan).when(F.col("_best0").isNull(), best).otherwise(F.least(running, "_best0"))
        earlier = -F.col("_bad0")
    x = x.withColumn("best_loss", best).withColumn("_k", F.col("_pcount") + F.row_number().over(w))

    b = F.col("best_loss")
    finite = ~F.isnan(b) & ~F.isnan(v)
    new_best = b.isNull() | (finite & (v < b))
    x = x.withColumn("is_bad", ~new_best & finite & (v > b * F.lit(float(threshold))))

    # Second scan: position (_k) of the last good row at or before each row.
    good_k = F.when(~F.col("is_bad"), F.col("_k"))
    last = x.groupBy(run, "_c").agg(F.max(good_k).alias("_clast"))
    last = last.withColumn("_plast", F.max("_clast").over(cw))
    x = _join_small(x, last.select(run, "_c", "_plast"), [run, "_c"], n_chunks)
    in_chunk = F.max(good_k).over(w.rowsBetween(Window.unboundedPreceding, 0))
    last_good = F.coalesce(in_chunk, F.col("_plast"), earlier)
    x = x.withColumn("bad_streak", (F.col("_k") - last_good).cast("long"))
    x = x.withColumn("should_stop", F.col("bad_streak") >= F.lit(int(patience)))
    return x.drop("_c", "_pmin", "_pcount", "_first", "_s0", "_k", "_plast", "_best0", "_bad0")


def stop_steps(div: DataFrame, run: str = "run", step: str = "step") -> DataFrame:
    """First step at which each run would stop (runs that never stop omitted)."""
    return div.filter("should_stop").groupBy(run).agg(F.min(step).alias("stop_step"))


def cost_meter(
    metrics: DataFrame, price: float = fixed.GPU_HOUR_PRICE, run: str = "run", ts: str = "ts"
) -> DataFrame:
    """Adds elapsed_hours and cost (elapsed_hours × price per GPU hour).

    The start of each run is an aggregate (partial per task) joined back, so
    rows are never shuffled by run.
    """
    starts = materialize(metrics.groupBy(run).agg(F.min(ts).alias("_t0")))
    x = _join_small(metrics, starts, [run], starts.count())
    hours = F.timestamp_diff("MICROSECOND", F.col("_t0"), F.col(ts)).cast("double") / F.lit(3.6e9)
    x = x.withColumn("elapsed_hours", hours).withColumn("cost", F.col("elapsed_hours") * F.lit(float(price)))
    return x.drop("_t0")


def best_checkpoint(
    metrics: DataFrame, run: str = "run", step: str = "step", loss: str = "eval_loss"
) -> DataFrame:
    valid = metrics.filter(F.col(loss).isNotNull() & ~F.isnan(loss))
    best = F.min_by(F.struct(F.col(step).alias("s"), F.col(loss).alias("l")), F.struct(loss, step))
    return valid.groupBy(run).agg(best.alias("_b")).select(
        run, F.col("_b.s").alias("best_step"), F.col("_b.l").alias("best_loss")
    )
