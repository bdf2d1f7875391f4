"""Stream monitors with a table of states: equal to a walk over each run, over several batches and replays."""

import glob
import math
import os
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarry.streaming import monitors, scans

SCHEMA = "run long, ts timestamp_ntz, eval_loss double, n long"
T0 = datetime(2024, 1, 1)


def walk(rows, threshold=1.5, patience=3):
    out, state = [], {}
    for run, _, loss, _ in rows:
        best, bad, seen = state.get(run, (None, 0, 0))
        seen += 1
        if loss is not None:
            was = best
            if best is None or loss < best:
                best, bad, flag = loss, 0, False
            elif loss > best * threshold:
                bad, flag = bad + 1, True
            else:
                bad, flag = 0, False
            out.append((run, seen, loss, was, flag, bad, bad >= patience))
        state[run] = best, bad, seen
    return sorted(map(str, out))


def log(seed, n=400):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, None]), T0 + timedelta(minutes=i // 3), rng.choice([None, math.nan, 1.0, 2.0, 3.0, 5.0, rng.random() * 9]), i) for i in range(n)]
    return [(9, T0, math.nan, -1), *rows, (9, T0 + timedelta(days=9), 1.0, n), (9, T0 + timedelta(days=9), 5.0, n + 1)]


def landed(spark, folder, rows):
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    df.write.mode("append").parquet(folder)
    return monitors.metrics_stream(spark, folder, df.schema)


def shown(df):
    return sorted(str(tuple(r)) for r in df.select("run", "step", "eval_loss", "best_loss", "is_bad", "bad_streak", "should_stop").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_carry_the_state(spark, seed):
    rows, folder, path = log(seed), tempfile.mkdtemp(prefix="log-"), tempfile.mkdtemp(prefix="scan-")
    for i in range(0, len(rows), 150):
        got = scans.divergence_scan(landed(spark, folder, rows[i : i + 150]), tie="n", path=path)
    assert shown(got) == walk(rows)
    # The last batch is played again, as after a failure before its commit.
    last = max(glob.glob(f"{path}/_checkpoint/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for p in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):
        if os.path.exists(p):
            os.remove(p)
    again = scans.divergence_scan(monitors.metrics_stream(spark, folder, SCHEMA), tie="n", path=path)
    assert shown(again) == walk(rows)


def test_cost_goes_on_from_the_first_row(spark):
    rows, folder, path = log(3, 60), tempfile.mkdtemp(prefix="log-"), tempfile.mkdtemp(prefix="scan-")
    for i in range(0, len(rows), 25):
        got = scans.cost_scan(landed(spark, folder, rows[i : i + 25]), price=2.0, path=path)
    start, seen, want = {}, {}, []
    for run, ts, _, _ in rows:
        start.setdefault(run, ts)
        seen[run] = seen.get(run, 0) + 1
        hours = (ts - start[run]).total_seconds() / 3600
        want.append((run, round(hours, 9), round(2 * hours, 9)))
    assert sorted(map(str, want)) == sorted(str((r.run, round(r.elapsed_hours, 9), round(r.cost, 9))) for r in got.collect())
    assert sorted(map(str, seen.items())) == sorted(str((r.run, r.n)) for r in got.groupBy("run").agg(F.max("step").alias("n")).collect())


def test_idle_runs_are_dropped(spark):
    rows = [(1, T0, 1.0, 0), (2, T0 + timedelta(days=5), 1.0, 1)]
    folder, path = tempfile.mkdtemp(prefix="log-"), tempfile.mkdtemp(prefix="scan-")
    scans.divergence_scan(landed(spark, folder, rows), tie="n", path=path, idle="1 day")
    assert [r.run for r in spark.read.parquet(f"{path}/state/batch=0").collect()] == [2]
