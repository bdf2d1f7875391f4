import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import ann
from tests.conftest import SF01


def test_hilbert_visits_every_cell_in_steps_of_one():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * d)).reshape(d, -1).T
        at = ann.hilbert(cells, bits)
        assert sorted(at) == list(range(len(cells)))
        path = cells[np.argsort(at)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def brute(rows, every, k):
    """All answers by brute force, from (id, vector) rows that take part."""
    out = {}
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], float)
    unit = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    for n in np.flatnonzero(ids % every == 0):
        score = unit @ unit[n]
        order = [j for j in np.lexsort((ids, -score.round(12))) if ids[j] != ids[n]][:k]
        out[int(ids[n])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got = out.setdefault(r.query_id, [])
        assert r["rank"] == len(got) + 1
        got.append((r.vec_id, r.score))
    return out


def recall(got, want):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hit / sum(len(w) for w in want.values())


def check_scores(got, rows):
    v = dict(rows)
    for q, found in got.items():
        for i, s in found:
            a, b = np.array(v[q], float), np.array(v[i], float)
            assert abs(s - a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)) < 1e-12
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_embeddings(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = answers(ann.nearest_neighbours(df)), brute(rows, 50, 5)
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    check_scores(got, rows)
    assert recall(got, want) >= 0.9


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_on_more_rows(spark, clustered):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((3000, 24))
    if clustered:
        v = np.repeat(rng.standard_normal((300, 24)), 10, axis=0) + 0.1 * v
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v.astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    old, ann.BLOCK = ann.BLOCK, 128
    try:
        got = answers(ann.nearest_neighbours(df, every=10))
    finally:
        ann.BLOCK = old
    check_scores(got, rows)
    assert recall(got, brute(rows, 10, 5)) >= 0.9


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (50, []),
            (100, [0.0, 1.0]), (150, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (200, [-0.0, 1.0])]
    rows += [(1000 + i, [0.5, 0.5]) for i in range(300)] + [(100, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for c in ("item", "size", "key", "rank", "v", "vector"):
        df = df.withColumn(c, F.lit("x"))
    valid = {i: v for i, v in rows if i is not None and v and len(v) == 2 and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    got = answers(ann.nearest_neighbours(df))
    want = brute(list(valid.items()), 50, 5)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
    assert ann.nearest_neighbours(df.limit(0)).count() == 0
    assert ann.nearest_neighbours(df.filter("vec_id = 0")).count() == 0
    assert answers(ann.nearest_neighbours(df.filter("vec_id < 3")))[0][0][0] == 1


def test_huge_and_tiny_components(spark):
    """Squares that would overflow or vanish: each row is a plain vector times a power of two, and so are its answers."""
    rng = np.random.default_rng(3)
    plain = [(50 * (i % 5 == 0) * (i + 1) or 1000 * i + 1, [float(x) for x in rng.integers(-9, 10, 6) + 0.5]) for i in range(60)]
    power = [0, 1000, -1000, 600, -1060]
    rows = [(i, [float(np.ldexp(x, power[n % 5])) for x in v]) for n, (i, v) in enumerate(plain)]
    schema = "vec_id long, embedding array<double>"
    got, want = (answers(ann.nearest_neighbours(spark.createDataFrame(r, schema))) for r in (rows, plain))
    assert got == want and len(got) == 12
    tiny = [(0, [1e-200, 0.0]), (1, [1e-200, 0.0]), (2, [1e200, 1e200]), (3, [5e-324, 0.0])]
    got = answers(ann.nearest_neighbours(spark.createDataFrame(tiny, schema)))
    assert [i for i, _ in got[0]] == [1, 3, 2] and [s for _, s in got[0]][:2] == [1.0, 1.0] and abs(got[0][2][1] - 0.5**0.5) < 1e-15


def test_both_sides_of_a_group_are_bounded(spark, monkeypatch):
    """Every row asks and the window covers all: each pair meets once, in groups of at most BLOCK by BLOCK."""
    monkeypatch.setattr(ann, "BLOCK", 16)
    ranked = spark.range(100).select(F.col("id").cast("string").cast("binary").alias("item"), F.lit(2).alias("size"), F.lit(0).alias("curve"), (F.col("id") + 1).alias("rank"))
    items = ranked.select("item", "size", F.lit(b"v").alias("vector"), F.array("rank").alias("ids"))
    members, queries = ann.dealt(ranked, items, items, 200)
    at = ["size", "curve", "block", "deal"]
    q = [f"q_{c}" for c in at]
    assert max(r["count"] for r in members.groupBy(*at).count().collect()) <= 16
    assert max(r["count"] for r in queries.groupBy(*q).count().collect()) <= 16
    pairs = members.join(queries, [F.col(a) == F.col(b) for a, b in zip(at, q)])
    assert pairs.count() == pairs.select("item", "q_item").distinct().count() == 100 * 100
