"""The audit against a plain version in exact integers, and the trees against plain sums."""

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import divergence_audit as D
from tests.conftest import SF001

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows):
    """rows: (text, lang, source)."""
    n, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(FOLD))
        n[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in {k[0] for k in n}:
        kept = [t for t, d in docs[lang].items() if d >= 3]
        groups = {s: c for (la, s), c in n.items() if la == lang}
        whole = sum(groups.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept))

        shares = {s: {t: p(c, t) for t in kept} for s, c in groups.items()}
        of_lang = {t: p(whole, t) for t in kept}
        f = lambda a, b: (a - b) * (a - b) // b
        for s, c in groups.items():
            pair = [(o, sum(f(shares[s][t], shares[o][t]) for t in kept)) for o in groups if o != s]
            term = [(t, f(shares[s][t], of_lang[t])) for t in kept if c[t] > 0 and shares[s][t] > of_lang[t]]
            for part, items, most in (("pair", pair, None), ("term", term, 200)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:most], 1)]
    return sorted(map(str, out))


def audit(df, **options):
    return sorted(str(tuple(r)) for r in D.audit_sources(df, **options).collect())


def test_the_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert audit(docs) == brute([(r.text, r.lang, r.source) for r in docs.collect()])


def odd():
    rows = [("Ab ab AB é É", "en", "a"), ("ab é cd", "en", "b"), ("cd ab é", "en", None), ("cd cd x", "en", "a"), (None, "en", "empty"), ("", "en", "")]
    rows += [("only one", "xx", s) for s in ("a", "b")] + [("12 -- _^", None, "n"), (None, None, None), ("alone", "yy", "z")]
    rows += [("same text here", "de", f"s{i % 7}") for i in range(30)] + [("word " * 5000 + "x[y`z{a", "de", "long")]
    rows += [(f"t{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}", "fr", f"s{i % 3}") for i in range(100) for _ in range(3)]
    return rows


def test_odd_rows(spark):
    rows = odd()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    df = df.withColumns({c: F.lit("x") for c in ("term", "n", "docs", "item", "total", "v", "block", "tile")})
    want = brute(rows)
    assert audit(df) == want
    assert audit(df, block=8, tile=2) == want
    assert D.audit_sources(df.limit(0)).count() == 0


def test_top_terms_only(spark):
    rows = odd()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    got = D.audit_sources(df, top=5).filter("part = 'term'").groupBy("lang", "source").count().collect()
    assert max(r["count"] for r in got) == 5


def test_trees_price_equal_pairs_once():
    rng = np.random.default_rng(1)
    leaves = np.where(rng.random((6, 64)) < 0.1, rng.integers(1, 5, (6, 64)), 0)
    leaves[3] = leaves[2]
    leaves[:, 60:] = D.PADDING
    forest = D.Forest(leaves)
    assert forest.roots[2] == forest.roots[3] and len(set(forest.roots)) == 5
    assert len(forest.children[0][0]) < 6 * 32  # equal subtrees are one node
    a, b = np.triu_indices(6, 1)
    pair, x, y, times = forest.meets(a, b)
    assert len({*zip(pair, x, y)}) == len(pair)
    for i in range(len(a)):
        want = Counter(zip(leaves[a[i], :60].tolist(), leaves[b[i], :60].tolist()))
        assert want == Counter({(int(u), int(v)): int(t) for k, u, v, t in zip(pair, x, y, times) if k == i})
    totals = leaves[:, :60].sum(1) + 60
    there, back = D.block_prices(leaves, totals, a, b)
    for i in range(len(a)):
        p, q = (D.shares(leaves[g, :60], totals[g]).tolist() for g in (a[i], b[i]))
        assert there[i] == sum((s - t) ** 2 // t for s, t in zip(p, q)) and back[i] == sum((s - t) ** 2 // s for s, t in zip(p, q))


def test_shares_are_exact():
    counts = [0, 1, 7, 10**12, 9 * 10**13]
    totals = [1, 3, 10**9 + 7, 10**13, 9 * 10**14]
    for c in counts:
        for t in totals:
            if c + 1 <= t:
                assert int(D.shares(np.array([c]), np.array([t]))[0]) == 1 + 10**9 * (c + 1) // t
