"""Property tests: Spark expressions against Python on generated batches."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.functions.docstring import with_docstring_stripped
from quarry.functions.text import clean

from .test_functions import model_strip_docstring

WS = st.sampled_from(list(" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0       　"))
TEXT = st.lists(st.one_of(WS, st.characters(), st.sampled_from(['"""', "'''", "r", "b", "\n"])), max_size=30).map("".join)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=40))
def test_clean_is_python_strip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.c for r in df.select("i", clean("s").alias("c")).collect()}
    assert all(got[i] == (v or "").strip() for i, v in enumerate(values))


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_docstring_rule(spark, codes):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, s string")
    got = {r.i: r.r for r in with_docstring_stripped(df, "s", "r").collect()}
    assert all(got[i] == model_strip_docstring(c) for i, c in enumerate(codes))
