"""Packing against the sequential rule, on literal cases and random ones."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import pack as P
from quarry.operators.order import order_hash


def sequential(samples, L, eos):
    """The rule, one sample at a time: (blocks, starts)."""
    blocks, buf_ids, buf_lab, starts = [], [], [], []
    pos = 0
    for ids in samples:
        if buf_ids:
            buf_ids.append(eos)
            buf_lab.append(-100)
            pos += 1
        starts.append(pos)
        buf_ids.extend(ids)
        buf_lab.extend(ids)
        pos += len(ids)
        while len(buf_ids) >= L:
            blocks.append((buf_ids[:L], buf_lab[:L]))
            buf_ids, buf_lab = buf_ids[L:], buf_lab[L:]
    return blocks, starts, len(buf_ids)


def run(spark, lens, L, parts=1, chunk_rows=1 << 20, fanout=1024, materialize_input=False, labelled=True):
    rows = [(i, [100 + i] * n) for i, n in enumerate(lens)]
    df = spark.createDataFrame(rows, "id long, input_ids array<int>").repartition(parts)
    df = df.withColumn("labels", F.col("input_ids")) if labelled else df
    order = [r.id for r in df.select("id", order_hash("id").alias("h")).orderBy("h", "id").collect()]
    samples = [rows[i][1] for i in order]
    blocks = P.pack(df, "id", L, eos_id=7, chunk_rows=chunk_rows, fanout=fanout,
                    materialize_input=materialize_input).orderBy("block_id").collect()
    starts = P.sample_starts(df, "id", L, chunk_rows=chunk_rows, fanout=fanout).collect()
    return blocks, {r.id: r.pack_start for r in starts}, samples, order


@pytest.mark.parametrize(
    "lens",
    [[8, 8], [3, 4, 8], [7, 1], [0, 5], [5, 0, 2], [], [1, 2], [3, 3, 3, 3, 3, 3, 3, 3, 3]],
)
def test_literal_cases(spark, lens):
    L = 8
    blocks, starts, samples, order = run(spark, lens, L, parts=2, materialize_input=len(lens) % 2 == 1, labelled=len(lens) % 3 > 0)
    exp_blocks, exp_starts, _ = sequential(samples, L, 7)
    assert [(list(b.input_ids), list(b.labels)) for b in blocks] == exp_blocks
    assert [starts[i] for i in order] == exp_starts
    for b in blocks:
        assert list(b.attention_mask) == [1] * L


@pytest.mark.parametrize("parts,chunk_rows,fanout", [(1, 1 << 20, 1024), (3, 7, 1024), (7, 5, 3), (2, 1, 2), (64, 16, 4)])
def test_random_against_sequential(spark, parts, chunk_rows, fanout):
    rnd = random.Random(parts * 31 + chunk_rows)
    for L in (2, 5, 9):
        lens = [rnd.choice([0, 1, 2, L - 1, L, rnd.randint(0, L)]) for _ in range(60)]
        blocks, starts, samples, order = run(spark, lens, L, parts, chunk_rows, fanout)
        exp_blocks, exp_starts, _ = sequential(samples, L, 7)
        assert [starts[i] for i in order] == exp_starts
        assert [(list(b.input_ids), list(b.labels)) for b in blocks] == exp_blocks


def test_skip_table_matches_replay():
    rnd = random.Random(5)
    for _ in range(200):
        L = rnd.randint(2, 9)
        lens = [rnd.randint(0, L) for _ in range(rnd.randint(0, 12))]
        table = P._skip_table(__import__("numpy").array(lens, dtype="int64"), L)
        for e in range(L):
            pos, skips = e, 0
            for n in lens:
                if pos % L == 0:
                    skips += 1
                else:
                    pos += 1
                pos += n
            assert table[e] == skips


def test_positions_restart_per_role(spark):
    rnd = random.Random(11)
    L = 6
    rows = [(i, "ab"[i % 2], [100 + i] * rnd.randint(0, L)) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, role string, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    both = P.pack(df, "id", L, eos_id=7, partition_by=["role"], chunk_rows=9, fanout=2).collect()
    for role in "ab":
        sub = df.filter(F.col("role") == role).drop("role")
        alone = P.pack(sub, "id", L, eos_id=7).orderBy("block_id").collect()
        mine = sorted((b for b in both if b.role == role), key=lambda b: b.block_id)
        assert [list(b.input_ids) for b in mine] == [list(b.input_ids) for b in alone]
        assert [b.block_id for b in mine] == [b.block_id for b in alone]


def test_collate_keeps_null_groups_and_checks_keys(spark):
    from quarry.operators.collate import collate

    rows = [(g, i, [i] * (i + 1)) for g in ("a", None) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, id long, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    got = collate(df, "id", 2, pad_id=0, partition_by=["g"]).collect()
    assert sorted((str(r.g), r.id) for r in got) == sorted((str(g), i) for g, i, _ in rows)
    for r in got:
        mates = [x for x in got if (x.g, x.batch) == (r.g, r.batch)]
        longest = max(x.id + 1 for x in mates)
        pad = longest - r.id - 1
        assert len(mates) <= 2 and r.batch_len == longest
        assert list(r.input_ids) == [r.id] * (r.id + 1) + [0] * pad
        assert list(r.attention_mask) == [1] * (r.id + 1) + [0] * pad
        assert list(r.labels) == [r.id] * (r.id + 1) + [-100] * pad
    with pytest.raises(ValueError, match="unique"):
        collate(df, "id", 2)


TEXTS = ["", None, "abc", "naïve — ☃", "x" * 40, "12345678", "a", "", "zwölf", "𝄞𝄞𝄞", "line\nline", "\x00\x01", "y" * 8, "end"]


@pytest.mark.parametrize("max_len,group_tokens,parts,chunk_rows", [(8, 8, 1, 1 << 20), (8, 24, 5, 3), (5, 1, 3, 2), (16, 1 << 20, 2, 4), (1, 3, 4, 5)])
def test_bytes_are_packed_as_their_ids(spark, max_len, group_tokens, parts, chunk_rows):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(parts)
    order = [r.id for r in df.select("id", order_hash("id").alias("h")).orderBy("h", "id").collect()]
    exp, _, _ = sequential([list((rows[i][1] or "").encode()[:max_len]) for i in order], max_len, 300)
    got = P.pack_bytes(df, "id", max_len, eos_id=300, chunk_rows=chunk_rows, fanout=2, group_tokens=group_tokens).orderBy("block_id").collect()
    assert [b.block_id for b in got] == list(range(len(exp)))
    assert [(b.input_ids, b.labels) for b in got] == exp
    assert all(b.attention_mask == [1] * max_len for b in got)


def test_bytes_are_packed_per_group_with_its_length(spark):
    rows = [(i, [None, "a", "b"][i % 3], [6, 9, 4][i % 3], TEXTS[i % len(TEXTS)]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, role string, max_len int, text string")
    got = P.pack_bytes(df, "id", "max_len", eos_id=300, partition_by=["role"], chunk_rows=7, fanout=2, group_tokens=20).collect()
    order = [r.id for r in df.select("id", order_hash("id").alias("h")).orderBy("h", "id").collect()]
    for role, n in ((None, 6), ("a", 9), ("b", 4)):
        exp, _, _ = sequential([list((rows[i][3] or "").encode()[:n]) for i in order if rows[i][1] == role], n, 300)
        mine = sorted((b for b in got if b.role == role), key=lambda b: b.block_id)
        assert exp and [(b.input_ids, b.labels) for b in mine] == exp
        assert {b.max_len for b in mine} == {n}


def test_no_bytes_no_blocks(spark):
    for rows in ([], [(1, None)], [(1, ""), (2, None)], [(1, "abc")]):
        assert P.pack_bytes(spark.createDataFrame(rows, "id long, text string"), "id", 4).collect() == []
    with pytest.raises(ValueError, match="unique"):
        P.pack_bytes(spark.createDataFrame([(1, "a"), (1, "b")], "id long, text string"), "id", 4)
