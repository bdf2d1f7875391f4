"""Column functions on literal cases (FIXTURES §3) and against small Python models."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.functions import chat, text
from quarry.functions.arrays import cap_tests, coerce_tests, join_blank_line, join_tests
from quarry.functions.docstring import strip_docstring, with_docstring_stripped
from quarry.functions.render import render_chat, render_instruction


def one(spark, expr, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first().r


@pytest.mark.parametrize(
    "value",
    [None, "", "  a  ", " x　", "\u0085y\u001c", "\tz\n", "a\U0001F600b", "    "],
)
def test_clean_matches_python_strip(spark, value):
    assert one(spark, text.clean("s"), value) == (value or "").strip()


def test_whitespace_set_is_pythons():
    assert len(text.WHITESPACE) == 29
    assert all(c.isspace() for c in text.WHITESPACE)


@pytest.mark.parametrize("value", ["a" * 19, "a" * 20, " " + "a" * 19 + " ", "é" * 20, "\U0001F600" * 20])
def test_char_len_counts_code_points(spark, value):
    assert one(spark, text.char_len(text.clean("s")), value) == len(value.strip())


def test_first_line_and_window(spark):
    assert one(spark, text.first_line("s"), "ab\ncd") == "ab"
    assert one(spark, text.first_line("s"), None) is None
    assert one(spark, text.lower_window("s", 3), "ÉABCD") == "éab"
    assert one(spark, text.lower_window("s", 500), "\U0001F600" * 600) == "\U0001F600" * 500


MSG = "messages array<struct<role:string,content:string>>"


def msgs(*pairs):
    return [{"role": r, "content": c} for r, c in pairs]


@pytest.mark.parametrize(
    "role,expected",
    [("user", "user"), ("assistant", "assistant"), ("system", "system"), ("human", "user"),
     ("gpt", "assistant"), ("tool", "assistant"), ("User", "assistant"), (None, "assistant")],
)
def test_normalize_role(spark, role, expected):
    out = one(spark, chat.clean_messages("messages"), msgs((role, " x ")), MSG)
    assert [(m.role, m.content) for m in out] == [(expected, "x")]


def test_clean_messages_drops_blank_keeps_order(spark):
    out = one(spark, chat.clean_messages("messages"), msgs(("user", " a "), ("assistant", "  "), ("human", None), ("gpt", "b")), MSG)
    assert [(m.role, m.content) for m in out] == [("user", "a"), ("assistant", "b")]


def model_any_keyword(messages, kws, n=500):
    joined = " ".join((m["content"] or "")[:n].lower() for m in messages)
    return any(k in joined for k in kws)


@pytest.mark.parametrize(
    "messages",
    [
        msgs(("user", "x" * 494 + "python"), ("assistant", "b")),   # ends at 500: kept
        msgs(("user", "x" * 495 + "python"), ("assistant", "b")),   # crosses 500: lost
        msgs(("user", "please import"), ("assistant", "b")),         # "import" + joining space
        msgs(("user", "a"), ("assistant", "please import")),         # last: no space after
        msgs(("user", "a"), ("assistant", None), ("user", "def f")),  # null in the middle
    ],
)
def test_any_keyword_window(spark, messages):
    kws = ("python", "import ", "def ")
    assert one(spark, chat.any_keyword("messages", kws), messages, MSG) == model_any_keyword(messages, kws)


def test_all_groups_first_message_only(spark):
    groups = (("faster", "slow"), ("python",))
    assert one(spark, chat.all_groups_first("messages", groups), msgs(("user", "Make PYTHON faster"), ("assistant", "")), MSG)
    assert not one(spark, chat.all_groups_first("messages", groups), msgs(("user", "faster"), ("assistant", "python")), MSG)
    assert not one(spark, chat.all_groups_first("messages", groups), msgs(("user", "python only")), MSG)


def test_assistant_reply_keeps_empties(spark):
    m = msgs(("assistant", "first"), ("assistant", " a "), ("user", "u"), ("assistant", " "), ("gpt", "g"), ("assistant", "b"))
    parts = one(spark, chat.later_assistant_parts("messages"), m, MSG)
    assert list(parts) == ["a", "", "b"]
    assert one(spark, chat.assistant_reply(chat.later_assistant_parts("messages")), m, MSG) == "a\n\n\n\nb"
    assert list(one(spark, chat.later_assistant_parts("messages"), msgs(("assistant", "only")), MSG)) == []
    assert list(one(spark, chat.later_assistant_parts("messages"), [], MSG)) == []


def test_first_content(spark):
    assert one(spark, chat.first_content("messages"), msgs(("system", "s"), ("user", "u")), MSG) == "s"
    assert one(spark, chat.first_content("messages"), [], MSG) is None


def test_cap_tests_first_five_then_blanks(spark):
    tests = ["t1", " ", "", "t4", "t5", "t6", "t7"]
    kept = one(spark, cap_tests(F.col("s")), tests, "s array<string>")
    assert list(kept) == ["t1", "t4", "t5"]
    assert list(one(spark, cap_tests(F.col("s")), [" ", ""], "s array<string>")) == []


def test_coerce_tests_by_schema(spark):
    df = spark.createDataFrame([([{"code": " a "}, {"code": None}, None],)], "t array<struct<code:string>>")
    out = df.select(coerce_tests("t", df.schema["t"].dataType).alias("r")).first().r
    assert list(out) == [" a ", "", "None"]
    df2 = spark.createDataFrame([(["x", None],)], "t array<string>")
    assert list(df2.select(coerce_tests("t", df2.schema["t"].dataType).alias("r")).first().r) == ["x", "None"]


def test_join_tests_no_cleaning(spark):
    assert one(spark, join_tests(F.col("s")), [" a", "", "b "], "s array<string>") == " a\n\nb "
    assert one(spark, join_blank_line(F.col("s")), ["a", "b"], "s array<string>") == "a\n\nb"


def model_strip_docstring(code: str) -> str:
    """Independent statement of the rule (see functions/docstring.py)."""
    lines = code.split("\n")
    opener = None
    for i, line in enumerate(lines):
        chk = line.strip().lstrip("rRuUbB")
        if chk[:3] in ('"""', "'''"):
            opener = i
            break
    if opener is None:
        return code
    chk = lines[opener].strip().lstrip("rRuUbB")
    q = chk[:3]
    if q in chk[3:]:
        end = opener
    else:
        end = next((j for j in range(opener + 1, len(lines)) if q in lines[j]), len(lines) - 1)
    return "\n".join(lines[:opener] + lines[end + 1:])


DOC_CASES = [
    "def f():\n    return 1",
    'def f():\n    """One line."""\n    return 1',
    'def f():\n    """Multi\n    line.\n    """\n    return 1',
    'def f():\n    r"""Raw."""\n    return 1',
    "def f():\n    '''Single quotes\n    '''\n    return 1",
    'def f():\n    """Text\n    end""" trailing\n    return 1',
    'def f():\n    """Unclosed\n    return 1',
    'def f():\n    """First."""\n    """Second."""\n    return 1',
    'x = """a"""\ny = 1',
    '"""Module doc on line 1."""\nimport os',
    'def f():\n    """Doc."""\n',
    "",
    '   \t"""\n"""',
    'bR"""prefix letters"""\nz',
]


@pytest.mark.parametrize("code", DOC_CASES)
def test_strip_docstring_cases(spark, code):
    expected = model_strip_docstring(code)
    assert one(spark, strip_docstring("s"), code) == expected
    df = spark.createDataFrame([(code,)], "s string")
    assert with_docstring_stripped(df, "s", "r").first().r == expected


def test_strip_docstring_random(spark):
    rnd = random.Random(7)
    atoms = ['"""', "'''", 'r"""', "x", " ", "def f():", "return", "'''a'''", '"""b"""', ""]
    codes = ["\n".join(" ".join(rnd.choice(atoms) for _ in range(rnd.randint(0, 3))) for _ in range(rnd.randint(1, 6)))
             for _ in range(400)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, s string")
    got = {r.i: r.r for r in with_docstring_stripped(df, "s", "r").collect()}
    assert all(got[i] == model_strip_docstring(c) for i, c in enumerate(codes))


def test_render_instruction_and_chat(spark):
    df = spark.createDataFrame([("Do {x} 100%", "", "out")], "i string, n string, o string")
    r = df.select(render_instruction("i", "n", "o").alias("t")).first().t
    assert r == "### Instruction:\nDo {x} 100%\n\n### Input:\n\n\n### Response:\nout"
    m = msgs(("user", "hi"), (None, "x"), ("assistant", None))
    assert one(spark, render_chat("messages"), m, MSG) == "<|user|>\nhi\n<|user|>\nx\n<|assistant|>\n"


def test_byte_encoder_holds_little_beside_its_ids():
    """Positions of all ids of a batch, eight bytes each and made thrice, were six times the ids."""
    import tracemalloc

    import pyarrow as pa

    from quarry.operators.tokenize import _arrow_bytes

    texts = pa.array(["x" * 5000, "é", None, ""] + ["y" * 3000] * 2000)
    tracemalloc.start()
    ids = _arrow_bytes(4096).func(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(x) for x in ids[:4]] == [4096, 2, 0, 0] and ids[1].as_py() == list("é".encode())
    assert peak < 1.5 * 4 * len(ids.flatten())
