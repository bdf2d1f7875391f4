"""Vocabulary tables and the encoder that joins them."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import vocabulary as V

TEXTS = [(1, "b a  a\tc"), (2, None), (3, ""), (4, " \n "), (5, "a é\x0bb zz"), (6, "the " * 900 + "end"), (None, "a x")]


def frame(spark):
    return spark.createDataFrame(TEXTS, "id long, text string").withColumns({c: F.lit("t") for c in ("token", "pos", "count")})


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def expected(min_count=1):
    counts = Counter(w for _, t in TEXTS for w in words(t))
    kept = sorted((w for w in counts if counts[w] >= min_count), key=lambda w: (-counts[w], w.encode()))
    return {w: (counts[w], i) for i, w in enumerate(kept, 1)}


def test_ids_fall_with_the_count(spark):
    got = {r.token: (r["count"], r.id) for r in V.build_vocabulary(frame(spark)).collect()}
    assert got == expected()
    most = V.build_vocabulary(frame(spark), max_size=2, first_id=10).collect()
    assert sorted((r.token, r.id) for r in most) == [("a", 11), ("the", 10)]
    assert V.build_vocabulary(frame(spark).limit(0)).count() == 0


@pytest.mark.parametrize("options", [{}, {"max_broadcast": 0, "piece_words": 7}])
def test_encoding_keeps_the_order(spark, options, monkeypatch):
    monkeypatch.setattr(V, "HOT_SHARE", 4)  # "the" is hot
    vocab = V.build_vocabulary(frame(spark), min_count=2).checkpoint()
    ids = {w: i for w, (_, i) in expected(2).items()}
    got = {r.id: r for r in V.encode_words(frame(spark), vocab, "id", **options).collect()}
    assert {k: r.input_ids for k, r in got.items()} == {k: [ids.get(w, 0) for w in words(t)] for k, t in TEXTS}
    assert all(r.labels == r.input_ids and r.attention_mask == [1] * len(r.input_ids) for r in got.values())
    cut = V.encode_words(frame(spark), vocab, "id", max_len=3, unknown_id=99, **options).filter("id = 5").first()
    assert cut.input_ids == [ids["a"], 99, ids["b"]]
    assert V.encode_words(frame(spark).limit(0), vocab, "id", **options).count() == 0


def test_keys_must_be_unique(spark):
    df = frame(spark).withColumn("id", F.lit(1))
    with pytest.raises(ValueError, match="unique"):
        V.encode_words(df, V.build_vocabulary(df), "id")


@pytest.mark.parametrize("options", [{}, {"max_broadcast": 0, "piece_words": 3}])
def test_words_meet_the_vocabulary_once_a_slice(spark, options, monkeypatch):
    """A row for each word of the text would be collected and sorted by document."""
    monkeypatch.setattr(V, "SLICE_BYTES", 200)
    vocab = V.build_vocabulary(frame(spark)).checkpoint()
    got = V.encode_words(frame(spark), vocab, "id", **options)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "posexplode" not in plan and "FlatMapCoGroupsInArrow" in plan
    ids = {w: i for w, (_, i) in expected().items()}
    assert {r.id: r.input_ids for r in got.collect()} == {k: [ids[w] for w in words(t)] for k, t in TEXTS}
