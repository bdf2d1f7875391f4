import re

from pyspark.sql import functions as F

from quarry.llm import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, stop what is above its stop, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left, free = total - sum(fixed.values()), [s for s in names if s not in fixed]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**{s: share[s] for s in free}, **fixed}
        fixed |= {s: most * sizes[s] for s in over}


def words(n, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(n))


def corpus(spark):
    rows = [(i, words(7 + i % 5, f"h{i}_"), "hot") for i in range(300)]
    rows += [(1000, words(40), "tiny"), (1001, None, "b"), (1002, "", "b"), (1003, words(9), None), (None, words(5), "b"), (None, None, None)]
    rows += [(1004, words(11), "c"), (1004, words(11), "c"), (1005, " \t\n", "empty"), (1006, words(5000), "long"), (1007, "a b c", "\U0001F600"), (1008, words(3), "￿")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return rows, df.withColumn("size", F.lit("x")).withColumn("th", F.lit(1)).withColumn("key", F.lit(2)).withColumn("n", F.lit(3))


def test_targets_and_takes(spark):
    rows, df = corpus(spark)
    size = lambda t: len(WORD.findall(t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = targets(sizes)
    got = mix.mix(df).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and (r.position is None) == (r.taken == 0)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mix.mix(df.repartition(7)).collect()))
    assert mix.mix(df.limit(0)).count() == 0


def test_rows_of_the_mix(spark):
    rows, df = corpus(spark)
    per = {(r.doc_id, r.th): 0 for r in mix.mix(df).collect()}
    for r in mix.mix(df).collect():
        per[r.doc_id, r.th] += r.taken
    out = mix.mixed_rows(df)
    assert out.columns == df.columns
    got, texts = out.collect(), {}
    for d, t, _ in rows:
        texts.setdefault(d, set()).add(t)
    n = 0
    for r in got:
        w = WORD.findall(r.text)
        n += len(w)
        assert any(t and (r.text == t or w == WORD.findall(t)[: len(w)]) for t in texts[r.doc_id])
    assert n == sum(per.values())
    assert mix.mixed_rows(df.limit(0)).count() == 0


def test_time_of_inverts_the_demand(spark):
    """Word c of a source comes when the integral of its schedule reaches c."""
    df = spark.createDataFrame([(i, words(10), "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    for r in mix.mix(df, weights=(1, 1), schedules=[(1.8, 0.2), (0.4, 1.6)]).collect():
        a, b = r.sched
        assert abs(a * r.position + (b - a) * r.position**2 / 2 - r.first_word / r.goal) < 1e-9


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    for x in (mix.mix(df), mix.mixed_rows(df)):
        assert "Python" not in x._jdf.queryExecution().executedPlan().toString()
