"""Each stage against a plain version of it on the same input, over the documents table and odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from quarry.llm import langid, tokens
from tests.conftest import SF001
from tests.llm import test_line_dedup, test_mix, test_simhash
from tests.llm.test_tokens import check_packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LONG = "the same long line stands in many documents"


def odd(spark):
    rows = [(10**6 + i, f"{LONG}\nword{i} and more words that differ {i * 7}", "en", "odd", 5) for i in range(4)]
    rows += [(10**6 + 10, None, None, None, None), (10**6 + 11, "12 !!", "en", "odd", 5), (10**6 + 12, "", "en", "odd", 0), (None, "no id has this text", None, "odd", None)]
    rows += [(10**6 + 13, "repeated row text", "en", "odd", 3)] * 2 + [(10**6 + 14, "x " * 9000, "de", "odd", 18000)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(*COLUMNS).union(odd(spark))
    results = [docs]
    for name, stage in P.STAGES:
        out = stage(spark, results[-1], SF001)
        if name != "best_fit_packing":
            assert out.columns == COLUMNS and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        out = spark.createDataFrame(out.collect(), out.schema)  # what the next stage reads
        results.append(out)
    rows = [x.collect() for x in results]
    plain = lambda x: sorted(map(str, (tuple(r) for r in x)))

    # 1: all documents with a letter stay as they were, once a language is learned
    assert plain(rows[1]) == plain(r for r in rows[0] if r.text and any(c.isalpha() for c in r.text))
    model = langid.learn_profiles(results[0].filter("crc32(cast(cast(doc_id as string) as binary)) % 4 != 2"))
    assert set(model) == {r.lang for r in rows[0] if r.lang}

    # 2: the lines that test_line_dedup.brute keeps
    want = test_line_dedup.brute([(r.doc_id, r.text) for r in rows[1]])
    got = sorted((str(r.doc_id), r.text, len(r.text)) for r in rows[2])
    assert sorted((str(eval(w)[0]), eval(w)[1], len(eval(w)[1])) for w in want) == got
    assert all(r.n_chars == len(r.text) for r in rows[2])

    # 3: one document of each class, the smallest id
    ids, texts = [r.doc_id for r in rows[2]], [r.text for r in rows[2]]
    classes = test_simhash.brute_classes([test_simhash.brute_fingerprint(t) for t in texts], ids)
    keep = {}
    for r, c in zip(rows[2], classes):
        if r.doc_id == c:
            keep.setdefault(c, set()).add(tuple(r))
    assert len(rows[3]) == len(keep)
    assert all(tuple(r) in keep[r.doc_id] for r in rows[3] if r.doc_id is not None)

    # 4: words taken of each source meet the targets; copies are whole texts but for one cut a source
    size = lambda t: len(test_mix.WORD.findall(t or ""))
    sizes, taken, texts, cut = {}, {}, {}, {}
    for r in rows[3]:
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
        texts[r.doc_id] = r.text
    for r in rows[4]:
        taken[r.source] = taken.get(r.source, 0) + size(r.text)
        if r.text != texts[r.doc_id]:
            cut[r.source] = cut.get(r.source, 0) + 1
            w = test_mix.WORD.findall(r.text)
            assert w == test_mix.WORD.findall(texts[r.doc_id])[: len(w)]
    assert all(abs(taken.get(s, 0) - t) <= 0.5 for s, t in test_mix.targets(sizes).items())
    assert all(n == 1 for n in cut.values())

    # 5: every row of the mix, whole, in as few sequences as its tokens need and one
    library = Tokenizer.from_file(tokens.vocabulary())
    want = []
    for r in rows[4]:
        x = np.array(library.encode(r.text, add_special_tokens=False).ids + [1], "<u4")
        want += [(r.doc_id, i, len(x[i : i + 4096]), zlib.crc32(x[i : i + 4096].tobytes())) for i in range(0, len(x), 4096)]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.start, r.length, r.ids_crc32)) for r in rows[5])
    assert check_packing(rows[5], 4096) <= -(-sum(r.length for r in rows[5]) // 4096) + 1


def test_run_on_the_smallest_table(spark):
    got = P.run(spark, SF001)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 0


def test_empty_table(spark):
    docs = odd(spark).limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF001).count() == 0


def test_texts_in_an_unknown_script_are_rejected(spark):
    rows = [(i, "the quick brown fox jumps over the lazy dog", "en") for i in range(40)] + [(100, "Ωμέγα", None), (101, "a dog", None)]
    kept = P.language_id(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == [*range(40), 101]


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like the operators' own keep their values."""
    extra = ["_language", "_lines", "keep_id", "keep_fp", "lost", "position", "row"]
    docs = odd(spark).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in extra})
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF001)
        assert docs.columns == [*COLUMNS, *extra], name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        for r in docs.collect():
            assert all(r[c] is None if r.doc_id is None else r[c] == f"{c}{r.doc_id}" for c in extra), name
