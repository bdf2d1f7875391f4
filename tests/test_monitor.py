"""Metric monitors: literal cases (incl. NaN), stream = batch, best checkpoint."""

import datetime as dt
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import monitor as M
from quarry.streaming import monitors as S

NAN = float("nan")


def model(losses, threshold=1.5, patience=3):
    """The rule, one evaluation at a time: (bad counter, stop) per non-null loss."""
    best, bad, out = None, 0, []
    for v in losses:
        if v is None:
            continue
        if best is None or v < best:
            best, bad = v, 0
        elif v > best * threshold:
            bad += 1
        else:
            bad = 0
        out.append((bad, bad >= patience))
    return out


CASES = [
    [1.0, 1.6, 1.6, 1.6],
    [1.0, 1.6, 1.2, 1.6],
    [1.0, 1.5, 1.5, 1.5],
    [1.0, 1.0, 1.6, 1.6, 1.6, 1.6],
    [NAN, 1.0, 0.5, 9.0],
    [1.0, NAN, 2.0, 2.0, 2.0],
    [1.0, None, 2.0, 2.0, 2.0],
    [2.0, 0.5, 0.8, 0.9, 1.0, 0.1],
]


def metrics_df(spark, runs):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(r, i + 1, t0 + dt.timedelta(minutes=7 * i + r), v) for r, losses in enumerate(runs) for i, v in enumerate(losses)]
    return spark.createDataFrame(rows, "run long, step long, ts timestamp_ntz, eval_loss double")


@pytest.mark.parametrize("chunk_steps", [1, 2, 3, 1 << 16])
def test_divergence_batch_literal(spark, chunk_steps):
    got = M.divergence(metrics_df(spark, CASES), chunk_steps=chunk_steps).orderBy("run", "step").collect()
    for r, losses in enumerate(CASES):
        mine = [(x.bad_streak, x.should_stop) for x in got if x.run == r]
        assert mine == model(losses), (r, losses)


def test_divergence_random_chunks(spark):
    import random

    rnd = random.Random(3)
    runs = [[rnd.choice([None, NAN, 0.5, 1.0, 1.4, 1.6, 2.0, 3.0, rnd.random() * 3]) for _ in range(rnd.randint(1, 40))]
            for _ in range(30)]
    got = M.divergence(metrics_df(spark, runs), chunk_steps=4).orderBy("run", "step").collect()
    for r, losses in enumerate(runs):
        assert [(x.bad_streak, x.should_stop) for x in got if x.run == r] == model(losses)


def _stream_dir(spark, df, parts=4):
    d = tempfile.mkdtemp(prefix="metrics-")
    # one file per time slice, so the stream sees several micro-batches in order
    for i in range(parts):
        df.filter(F.col("step") % parts == i).coalesce(1).write.mode("overwrite").parquet(os.path.join(d, f"p{i}"))
    return d


def test_divergence_stream_equals_batch_single_batch(spark):
    df = metrics_df(spark, CASES)
    d = tempfile.mkdtemp(prefix="metrics-")
    df.coalesce(1).write.mode("overwrite").parquet(os.path.join(d, "all"))
    stream = S.metrics_stream(spark, os.path.join(d, "all"), df.schema)
    got = S.run_available(S.divergence_stream(stream), "t-div")
    batch = M.divergence(df)
    cols = ["run", "step", "bad_streak", "should_stop", "is_bad"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def test_divergence_stream_across_micro_batches(spark):
    runs = [[1.0, 1.6, 1.6, 1.6, 0.5, 0.9, 0.9, 0.9, 0.2], [NAN, 1.0, 2.0], [2.0, 3.1, 3.2, 1.0, 1.9]]
    df = metrics_df(spark, runs)
    d = tempfile.mkdtemp(prefix="metrics-")
    for i, (lo, hi) in enumerate([(1, 2), (3, 4), (5, 7), (8, 9)]):
        part = df.filter((F.col("step") >= lo) & (F.col("step") <= hi))
        part.coalesce(1).write.parquet(os.path.join(d, f"f{i}"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(d)
    got = S.run_available(S.divergence_stream(stream, idle_timeout_ms=3_600_000), "t-div-multi").orderBy("run", "step").collect()
    for r, losses in enumerate(runs):
        assert [(x.bad_streak, x.should_stop) for x in got if x.run == r] == model(losses)


def test_cost_stream_equals_batch_across_files(spark):
    df = metrics_df(spark, [[1.0] * 9, [2.0] * 5])
    d = tempfile.mkdtemp(prefix="metrics-")
    for i, (lo, hi) in enumerate([(1, 3), (4, 6), (7, 9)]):
        df.filter((F.col("step") >= lo) & (F.col("step") <= hi)).coalesce(1).write.parquet(os.path.join(d, f"f{i}"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(d)
    got = S.run_available(S.cost_stream(stream, price=1.14, idle_timeout_ms=3_600_000), "t-cost")
    batch = M.cost_meter(df, price=1.14)
    a = sorted((r.run, r.step, round(r.cost, 9)) for r in got.collect())
    b = sorted((r.run, r.step, round(r.cost, 9)) for r in batch.collect())
    assert a == b
    assert max(x[2] for x in a) == pytest.approx(56 / 60 * 1.14)


def test_best_checkpoint(spark):
    df = metrics_df(spark, [[3.0, 1.0, 1.0, 2.0], [NAN, None, 5.0], [NAN]])
    got = {r.run: (r.best_step, r.best_loss) for r in M.best_checkpoint(df).collect()}
    assert got == {0: (2, 1.0), 1: (3, 5.0)}


def test_stop_steps(spark):
    got = {r.run: r.stop_step for r in M.stop_steps(M.divergence(metrics_df(spark, CASES))).collect()}
    assert got == {0: 4, 3: 5, 5: 5, 6: 5, 7: 5}
    assert all(not math.isnan(v) for v in got.values())


def test_idle_runs_lose_their_state(spark):
    t0 = dt.datetime(2024, 1, 1)
    schema = "run long, step long, ts timestamp_ntz, eval_loss double"
    batches = [
        [(0, 1, t0, 1.0), (0, 2, t0 + dt.timedelta(minutes=1), 2.0), (1, 1, t0, 1.0)],
        [(1, 2, t0 + dt.timedelta(hours=3), 1.0)],   # moves the watermark past run 0's timeout
        [(1, 3, t0 + dt.timedelta(hours=3, minutes=1), 1.0)],  # timeout of run 0 fires here
        [(0, 3, t0 + dt.timedelta(hours=4), 9.0)],   # run 0 again: starts from empty state
    ]
    d = tempfile.mkdtemp(prefix="idle-")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(d, f"b{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(d)
    got = S.run_available(S.divergence_stream(stream, idle_timeout_ms=3_600_000), "t-idle").collect()
    run0 = sorted((r.step, r.eval_loss, r.best_loss) for r in got if r.run == 0)
    # the last row of run 0 is counted from 1 again and has no best before it
    assert run0 == [(1, 1.0, None), (1, 9.0, None), (2, 2.0, 1.0)]
