"""Shards against their law, and the curve against a plain version of it."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import sharding as S
from quarry.session import scratch_path
from tests.conftest import SF01

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def check_law(rows, want, shards=16):
    """want: (doc_id, text) of the table."""
    n = len(want)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in want
    )
    by = {}
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        by.setdefault(r.shard, []).append(r)
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    last = -1
    for s in sorted(by):
        held = sorted(by[s], key=lambda r: r.slot)
        assert [r.slot for r in held] == list(range(len(held)))
        for r in held:  # shards and slots follow the curve
            assert r.curve >= last
            last = r.curve


def shard(spark, df, **options):
    return S.shard_documents(df, scratch_path(spark, "test-shards"), **options).collect()


def test_the_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    check_law(shard(spark, docs), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("n", [0, 1, 33])
def test_few_rows(spark, n):
    rows = [(i, None if i % 4 == 0 else f"text {i}", ["en", None, "de"][i % 3], f"source{i % 5}", i * 7) for i in range(n)]
    check_law(shard(spark, spark.createDataFrame(rows, SCHEMA)), [(r[0], r[1]) for r in rows])


def test_odd_rows(spark):
    rows = [(None, None, None, None, None)] * 50 + [(1, "same", "en", "a", 4)] * 77 + [(2, "", "", "", 0), (3, "x" * 300_000, "fr", "ä" * 400, 300_000)]
    rows += [(i, "copy", "en", "hot", 4) for i in range(10, 60)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("run", "shard", "curve", "h", "row", "tied", "r", "_shard"):
        df = df.withColumn(c, F.lit("x"))
    df = df.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    check_law(shard(spark, df, files=3), [(r[0], r[1]) for r in rows])
    path = scratch_path(spark, "test-shards")
    S.write_shards(df, path, dimensions=("lang", "n_chars"), shards=4)
    back = S.read_shards(spark, path, df.schema, out="_place")
    assert back.columns == [*df.columns, "_place"]
    assert sorted(map(str, back.drop("_place").collect())) == sorted(map(str, df.collect()))


def test_cells_follow_the_quantiles(spark):
    df = spark.createDataFrame([(i, None, None if i == 0 else f"same{chr(97 + i % 4)}", "s", i) for i in range(400)], SCHEMA)
    one = df.withColumn("c", S.curve_index(df, ["n_chars"], 2)).orderBy("n_chars").select("c").collect()
    cells = np.array([r.c for r in one])
    assert (np.diff(cells) >= 0).all() and set(cells) == {1, 2, 3}
    assert all(abs(np.sum(cells == k) - 400 / 3) < 3 for k in (1, 2, 3))
    text = {r.lang: r.c for r in df.withColumn("c", S.curve_index(df, ["lang"], 4)).collect()}
    assert text[None] == 0 and text["samea"] < text["sameb"] < text["samec"] < text["samed"]


def test_filters_leave_files_unread(spark):
    """A box in any of three dimensions meets few files; sorted by the first dimension alone, the others meet all."""
    rows = [(i, "t", f"l{i * 7919 % 16:02d}", f"s{i * 104729 % 16:02d}", i * 31 % 4096) for i in range(4096)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = scratch_path(spark, "test-shards")
    S.write_shards(df, path, shards=16, files=4, bits=4)
    ranges = S.run_ranges(spark, path, df.schema).collect()
    assert len(ranges) == 64 and sum(r.rows for r in ranges) == 4096
    for low, high, value in (("min_lang", "max_lang", "l05"), ("min_source", "max_source", "s05"), ("min_n_chars", "max_n_chars", 1300)):
        assert sum(r[low] <= value <= r[high] for r in ranges) <= 32
