from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm.line_dedup import deduplicate_lines

LONG, OTHER = "this line is long enough", "another long line of text"


def brute(rows):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    held = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= 20:
                held[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < 3 or max(held[key(x)]) == d]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(map(str, out))


def test_cases(spark):
    rows = [
        (1, f"{LONG}\nshort\n{OTHER}"), (2, f"  {LONG.upper()}\t\nshort"), (3, f"short\n{LONG}\r\n{LONG}\n"), (3, f"{LONG}\nagain"),
        (2, f"x\n{LONG}"), (4, None), (5, ""), (None, f"{LONG}\nno id"), (None, None), (6, OTHER), (6, OTHER), (7, "\n\n"),
        (8, "É" * 20), (9, "é" * 20), (10, "é" * 20), (11, "é" * 20), (12, f"a{LONG}\n" * 5000), (13, f"a{LONG}\n" * 3), (14, f"a{LONG}"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumn("lines", F.lit(0)).withColumn("id", F.lit("x")).withColumn("row", F.lit(1)).withColumn("pos", F.lit(2)).withColumn("key", F.lit(3))
    got = deduplicate_lines(df)
    assert got.columns == ["doc_id", "lines", "id", "row", "pos", "key", "_lines"]
    assert sorted(str((r[0], r._lines.text, r._lines.n_lines, r._lines.n_dropped)) for r in got.collect()) == brute(rows)
    assert deduplicate_lines(df.limit(0)).count() == 0
    # Beyond the bound of a broadcast the lines meet by key, hot ones in parts.
    got = deduplicate_lines(df, max_broadcast=0, part_docs=2, out="done")
    assert sorted(str((r[0], r.done.text, r.done.n_lines, r.done.n_dropped)) for r in got.collect()) == brute(rows)
    with pytest.raises(ValueError, match="has a column _lines"):
        deduplicate_lines(df.withColumn("_lines", F.lit(1)))


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    assert "Python" not in deduplicate_lines(df)._jdf.queryExecution().executedPlan().toString()
