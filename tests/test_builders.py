"""Builders on literal source rows (FIXTURES §1, §3)."""

import pytest

from quarry import fixed
from quarry.plans import builders as B


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_code_writer(spark):
    src = spark.createDataFrame(
        [(1, " Do it ", None, "x" * 20), (2, "Do", " in ", " " + "y" * 19 + " "), (3, None, "", "z" * 30),
         (4, "ok", "", "w" * 19), (5, "ok", "i", "é" * 20)],
        "id long, instruction string, input string, output string",
    )
    assert rows(B.code_writer(src), "id", "instruction", "input", "output") == [
        (1, "Do it", "", "x" * 20), (5, "ok", "i", "é" * 20)]


def test_test_generator_structs_and_strings(spark):
    tests = [{"code": "t1"}, {"code": " "}, {"code": ""}, {"code": "t4"}, {"code": "t5"}, {"code": "t6"}, {"code": "t7"}]
    src = spark.createDataFrame(
        [(1, " Q ", "code", tests), (2, "Q", "code", [{"code": " "}]), (3, "Q", " ", tests), (4, "Q", "c", [])],
        "id long, question string, code_ground_truth string, unit_tests array<struct<code:string>>",
    )
    out = B.test_generator(src).collect()
    assert [r.id for r in out] == [1]
    assert out[0].output == "t1\n\nt4\n\nt5"
    assert out[0].input == "## Problem\nQ\n\n## Implementation\n```python\ncode\n```"
    assert out[0].instruction == fixed.TEST_GENERATOR_INSTRUCTION
    src2 = spark.createDataFrame([(1, "Q", "c", ["a", " b "])], "id long, question string, code_ground_truth string, unit_tests array<string>")
    assert B.test_generator(src2).first().output == "a\n\nb"


def test_test_generator_fallback_keeps_blanks(spark):
    src = spark.createDataFrame([(1, "T", "c", [" a", "", "b"]), (2, "T", "c", [])], "id long, text string, code string, test_list array<string>")
    out = B.test_generator_fallback(src).collect()
    assert [(r.id, r.output) for r in out] == [(1, " a\n\nb")]
    assert out[0].input == "## Task\nT\n\n## Implementation\n```python\nc\n```"


MSG = "id long, messages array<struct<role:string,content:string>>"


def m(*pairs):
    return [{"role": r, "content": c} for r, c in pairs]


def test_static_reviewer(spark):
    src = spark.createDataFrame(
        [
            (1, m(("human", "use python"), ("gpt", " fine "))),
            (2, m(("user", "use python"), ("assistant", "  "))),        # one left after cleaning
            (3, m(("user", "no keyword"), ("assistant", "x"))),
            (4, m(("user", "python"))),                                 # one message
            (5, None),
            (6, m(("user", "x"), ("assistant", None), ("user", ".py file"))),
        ],
        MSG,
    )
    out = {r.id: [(x.role, x.content) for x in r.messages] for r in B.static_reviewer(src).collect()}
    assert out == {1: [("user", "use python"), ("assistant", "fine")], 6: [("user", "x"), ("user", ".py file")]}


def test_security_auditor(spark):
    src = spark.createDataFrame(
        [(1, " Python3 ", "V", "q", "good", "bad"), (2, "PY", None, "q", "g", "b"), (3, "python2", "V", "q", "g", "b"),
         (4, None, "V", "q", "g", "b"), (5, "py", "V", "q", "g", " ")],
        "id long, lang string, vulnerability string, question string, chosen string, rejected string",
    )
    out = {r.id: r for r in B.security_auditor(src).collect()}
    assert sorted(out) == [1, 2]
    assert out[1].input == "## Vulnerability Context\nV\n\n## Code to Audit\n```python\nbad\n```"
    assert out[1].output == "## Security Analysis\nV\n\n## Secure Implementation\n```python\ngood\n```"
    assert out[2].input.startswith("## Vulnerability Context\n\n\n")


def test_performance_optimizer(spark):
    src = spark.createDataFrame(
        [
            (1, m(("user", " Make this Python faster "), ("assistant", "a"), ("user", "u"), ("assistant", " "), ("assistant", "b"))),
            (2, m(("user", "faster"), ("assistant", "python"))),
            (3, m(("user", "python slow"), ("gpt", "x"))),
            (4, m(("assistant", "python slow"), ("user", "x"))),
        ],
        MSG,
    )
    out = {r.id: r for r in B.performance_optimizer(src).collect()}
    assert sorted(out) == [1]
    assert out[1].input == "Make this Python faster"
    assert out[1].output == "a\n\n\n\nb"


def test_docs_generator(spark):
    long_code = "def f():\n" + "x" * 4991
    src = spark.createDataFrame(
        [(1, 'def f():\n    """Doc here."""\n    return 1', "A docstring of twenty+"),
         (2, "def g(): pass", "short"),
         (3, long_code, "A docstring of twenty+"),
         (4, long_code + "y", "A docstring of twenty+")],
        "id long, code string, docstring string",
    )
    assert len(long_code) == 5000
    out = {r.id: r for r in B.docs_generator(src).collect()}
    assert sorted(out) == [1, 3]
    assert out[1].input == "```python\ndef f():\n    return 1\n```"


def test_build_all_isolates_failures(spark):
    src = spark.createDataFrame([(1, "i", "", "o" * 20)], "id long, instruction string, input string, output string")
    recs, failures = B.build_all({"code_writer": src}, roles=["code_writer", "docs_generator"])
    assert [r.role for r in recs.collect()] == ["code_writer"]
    assert [f[0] for f in failures] == ["docs_generator"]


@pytest.mark.parametrize("n", [None, 0, 2, 10])
def test_build_cap(spark, n):
    src = spark.createDataFrame([(i, "i", "", "o" * 20) for i in range(5)], "id long, instruction string, input string, output string")
    out = B.build(B.code_writer(src), max_samples=n).count()
    assert out == (5 if not n else min(n, 5))
