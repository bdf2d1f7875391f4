import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import langid, minhash
from tests.conftest import SF01


def jaccard(a, b, k=5):
    def sh(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    x, y = sh(a), sh(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def expected(rows):
    """(id, n_chars, edited text, next text) by a plain walk."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        k = len(t) // 3
        out.append((d, len(t), t[: len(t) - k] + nxt[:k], t, nxt))
    return out


def check(rows, got):
    want = expected(rows)
    assert sorted(str((w[0], w[1], hashlib.sha256(w[2].encode()).hexdigest())) for w in want) == sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got)
    sig = lambda t: minhash.signatures(*minhash._binary([t.encode()]))[0]
    expect = sorted(str((w[0], *(sig(x).astype(">u2").tobytes().hex() for x in (w[3], w[2])), float((sig(w[3]) == sig(w[2])).mean()), float((sig(w[3]) == sig(w[4])).mean()))) for w in want)
    assert expect == sorted(str((r.doc_id, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)) for r in got)
    return want


def test_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = minhash.compare_neighbours(docs).collect()
    want = {w[0]: w for w in check([tuple(r) for r in docs.select("doc_id", "text").collect()], got)}
    errors = [abs(r.near_edited - jaccard(want[r.doc_id][3], want[r.doc_id][2])) for r in got if r.n_chars > 200]
    assert np.mean(errors) < 0.05 and np.quantile(errors, 0.99) < 0.16


def test_edge_rows(spark):
    rows = [(5, "Ä b c d e f g h i"), (3, None), (None, "no id"), (None, "another without id"), (9, ""), (3, "a"), (3, "a"), (7, "w%d " * 4000), (-4, "\t\n"), (9, "zz" * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("range", "guest", "p", "item", "key", "n"):
        df = df.withColumn(c, F.lit("x"))
    check(rows, minhash.compare_neighbours(df).collect())
    check(rows[:1], minhash.compare_neighbours(df.limit(1)).collect())
    assert minhash.compare_neighbours(df.limit(0)).count() == 0 and minhash.near_duplicates(df.limit(0)).count() == 0
    assert len({r.fingerprint for r in minhash.fingerprints(df).filter("doc_id = 3").collect()}) == 2


def test_near_duplicate_classes_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(500)]
    rows = [(1, None), (2, ""), (3, " ")]
    for base in range(12):
        text = [words[i] for i in rng.integers(0, 500, 90)]
        for copy in range(6):
            t = list(text)
            for i in rng.integers(0, 90, copy // 2):
                t[i] = "new" + str(copy)
            rows.append((100 + base * 10 + copy, " ".join(t).upper() if copy == 1 else " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item", F.lit(1))
    root = {d: d for d, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, s) in enumerate(rows):
        for b, t in rows[:i]:
            if jaccard(s or "", t or "") >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    for bucket in (2, 512):
        assert {r.doc_id: r.class_id for r in minhash.near_duplicates(df, bucket_rows=bucket).collect()} == {d: find(d) for d, _ in rows}


def test_op6_links_near_copies_that_do_not_follow_each_other(spark, tmp_path):
    from quarry.llm import catalog

    text = " ".join(f"w{i}" for i in range(120))
    rows = [(1, text), (2, "other words stand here"), (7, text + " end"), (9, "more of these"), (9, text + " last"), (None, text.upper()), (None, ""), (12, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.op6_minhash(spark, str(tmp_path)).collect()
    check(rows, got)
    assert sorted(str((r.doc_id, r.n_chars, r.class_id)) for r in got) == sorted(str((d, len(t or ""), 1 if len(t or "") > 99 else 12 if not t else d)) for d, t in rows)


def test_low_similarity(spark):
    """Sizes alone link nothing, and the bands follow the similarity asked for."""
    assert minhash.bands_for(0.8) == 25 and minhash.bands_for(1.0) == 1
    for s in (0.4, 0.6, 0.9):
        n = minhash.bands_for(s)
        assert (1 - s ** (128 // n)) ** n <= 1e-4
    small, large = np.arange(10, dtype="<u4"), np.arange(100, 125, dtype="<u4")
    assert not minhash._near(small, large, 0.4) and minhash._near(small, np.arange(25, dtype="<u4"), 0.4)
    assert minhash._near(np.arange(55, dtype="<u4"), np.arange(100, dtype="<u4"), 0.55)
    rows = []
    for k in range(12):  # pairs whose second text keeps 60 of 100 words: 56 shingles of 136
        own = [f"a{k}x{i}" for i in range(100)]
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(own[:60] + [f"b{k}x{i}" for i in range(40)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(0.4 < jaccard(rows[2 * k][1], rows[2 * k + 1][1]) < 0.5 for k in range(12))
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(df, similarity=0.4).collect()} == {d: d // 2 * 2 for d, _ in rows}
    assert all(r.doc_id == r.class_id for r in minhash.near_duplicates(df, similarity=0.5).collect())


def test_parts_of_a_large_bucket_meet():
    sets = [np.arange(i, i + 20, dtype="<u4") for i in range(0, 12, 2)] + [np.arange(500, 520, dtype="<u4")]  # a chain and one apart
    out = minhash._forest(list(range(7)), [0, 0, 2, 3, 4, 5, 6], sets, 0.8).to_pylist()
    assert sorted((r["a"], r["b"]) for r in out) == [(1, 2), (2, 3), (3, 4), (4, 5)]


def test_languages_are_found(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = langid.language_of_documents(docs).select("lang", langid.held_out().alias("h"), "_language.*").collect()
    held = [r for r in rows if r.h]
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_profiles_and_distances_equal_brute_force(spark):
    texts = {"en": ["The quick brown fox, the lazy dog", "and then the end"], "fr": ["le vif renard brun", "été où ça"]}
    rows = [(i, t, lang) for lang, ts in texts.items() for i, t in enumerate(ts)] + [(9, None, "en"), (8, "nothing", None), (7, "", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = langid.learn_profiles(df, profile_size=25)
    assert set(p) == {"en", "fr"}
    for lang in p:
        counts = {}
        for t in texts[lang]:
            for c, n in _plain(t).items():
                counts[c] = counts.get(c, 0) + n
        assert p[lang] == sorted(counts, key=lambda c: (-counts[c], c))[:25]
    model = langid.Profiles(p, 25)
    for t in ("the dog", "où est le renard"):
        mine = langid.top(*langid.ngram_counts(t), 25).tolist()
        cost = {lang: sum(abs(p[lang].index(g) - i) if g in p[lang] else 25 for i, g in enumerate(mine)) for lang in p}
        best = min(sorted(cost), key=cost.get)
        assert model.predict(t) == (best, 1 - cost[best] / (len(mine) * 25))


def test_ngrams_of_words():
    for text in ("Ab, a\n1b", "", "12", "x", "Été où_ça", "a" * 50):
        assert dict(zip(*[x.tolist() for x in langid.ngram_counts(text)])) == _plain(text)
    big = "wörter und mehr " * 100_000  # several parts of a long text
    assert {k: v * 100_000 for k, v in _plain("wörter und mehr").items()} == dict(zip(*[x.tolist() for x in langid.ngram_counts(big)]))


def _plain(text):
    out = {}
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        c = [0, *map(ord, w), 0]
        for n in (1, 2, 3):
            for i in range(len(c) - n + 1):
                g = c[i : i + n]
                if n == 1 and not g[0]:
                    continue
                code = 0
                for x in g:
                    code = code << 21 | x
                out[code] = out.get(code, 0) + 1
    return out


def test_language_edge_rows(spark):
    rows = [(1, "hello there", "en"), (2, None, "en"), (3, "123 !!", "en"), (4, "", None), (None, "hello", None), (4, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("code", F.lit(1))
    got = langid.identify(df, langid.learn_profiles(df))
    assert got.columns == [*df.columns, "_language"]
    assert sorted(str((r.doc_id, r._language.lang_pred)) for r in got.collect()) == sorted(map(str, [(1, "en"), (2, "und"), (3, "und"), (4, "und"), (4, "und"), (None, "en")]))
    assert langid.identify(df, {}).first()._language == ("und", 0.0)
    assert langid.language_of_documents(df.limit(0)).count() == 0
