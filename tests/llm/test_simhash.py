import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import simhash
from tests.conftest import SF01

DOC = "doc_id long, text string"


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps, ids, most=3):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= most:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    want = {(r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_classes(fps, [r.doc_id for r in rows]))}
    got = {tuple(r) for r in simhash.simhash_classes(docs).collect()}
    assert got == want


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "ONE"), (5, "É two"), (6, "a b c d " * 20000), (None, "q r s t u")]
    df = spark.createDataFrame(rows, DOC).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(1)).withColumn("root", F.lit(2))
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted(map(str, zip([d for d, _ in rows], [f"{f:016x}" for f in fps], brute_classes(fps, [d for d, _ in rows]))))
    assert sorted(str(tuple(r)) for r in simhash.simhash_classes(df).collect()) == want
    assert simhash.simhash_classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("bucket_rows", [4, 1024])
def test_links_connect_what_is_near(spark, bucket_rows):
    """A dense ball, random values and chains, with buckets small enough to be dealt again."""
    rng = np.random.default_rng(7)
    base = int(rng.integers(1 << 62))
    fps = {base} | {int(x) for x in rng.integers(1 << 62, size=300)}
    fps |= {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (150, 2))}
    for start in list(fps)[:20]:
        for _ in range(4):
            start ^= sum(1 << int(b) for b in rng.choice(62, 3, replace=False))
            fps.add(start)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], T.StructType([T.StructField("fp", T.LongType())]))
    from quarry.llm.common import connected_components

    got = {r.node: r.root for r in connected_components(simhash.fingerprint_links(df, 3, bucket_rows)).collect()}
    want = brute_classes(fps, fps)
    assert [got.get(f, f) for f in fps] == want


def test_thresholds_follow_the_counts():
    cost = np.array([[900.0, 5000, 9000], [1, 2, 400], [1, 50, 400], [1, 50, 400]])
    assert simhash.allocate(cost, 3) == [-1, 1, 0, 0]
