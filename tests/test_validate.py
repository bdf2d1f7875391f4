"""Validation report on real files: line numbers, JSON rules, required keys."""

import hashlib
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import integrity as V

from .conftest import SF01


def write(dirpath, name, data: bytes):
    p = os.path.join(dirpath, name)
    with open(p, "wb") as f:
        f.write(data)
    return p


def report(spark, path, required=None, sha=None, strict=True):
    return sorted(
        ((os.path.basename(r.file), r.line, r.issue) for r in V.validate(spark, path, required, sha, strict).collect()),
        key=lambda x: (x[0], x[1] or 0, x[2]),
    )


def test_line_checks_and_numbers(spark):
    d = tempfile.mkdtemp(prefix="val-")
    lines = [
        '{"a": 1}',
        "",
        '{"a": 1} x',          # extra data
        '{"a": NaN}',          # Python accepts NaN
        "{'a': 1}",            # single quotes
        '{"a": 1, "a": 2}',    # duplicate keys are fine
        "[1]",                 # not an object
        "3",                   # not an object
        "   ",
        '{"b": 1}',            # missing a
        '{"a": null}',         # present with null passes
        '{"a": 1',             # truncated
    ]
    write(d, "x.jsonl", ("\r\n".join(lines) + "\n").encode())
    assert report(spark, d, ["a"]) == [
        ("x.jsonl", 3, "invalid_json"), ("x.jsonl", 5, "invalid_json"), ("x.jsonl", 7, "not_object"),
        ("x.jsonl", 8, "not_object"), ("x.jsonl", 10, "missing_fields"), ("x.jsonl", 12, "invalid_json"),
    ]


def test_line_numbers_across_splits(spark):
    d = tempfile.mkdtemp(prefix="val-")
    bad_at = {7, 1234, 4999}
    body = "\n".join('{"a": %d}' % i if i + 1 not in bad_at else "oops" for i in range(5000)) + "\n"
    write(d, "big.jsonl", body.encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = report(spark, d, ["a"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [("big.jsonl", n, "invalid_json") for n in sorted(bad_at)]


def test_missing_empty_blank_and_sha(spark):
    d = tempfile.mkdtemp(prefix="val-")
    assert report(spark, os.path.join(d, "nope"))[0][2] == "missing"
    write(d, "empty.jsonl", b"")
    write(d, "blank.jsonl", b"\n  \n")
    write(d, "ok.jsonl", b'{"a": 1}\n')
    got = report(spark, d)
    assert ("empty.jsonl", 0, "empty") in [(f, l or 0, c) for f, l, c in got]
    assert ("blank.jsonl", None, "no_records") in got
    assert all(f != "ok.jsonl" for f, _, _ in got)
    single = tempfile.mkdtemp(prefix="val-")
    p = write(single, "one.jsonl", b'{"a": 1}\n')
    good = hashlib.sha256(open(p, "rb").read()).hexdigest()
    assert report(spark, p, sha=good) == []
    assert report(spark, p, sha="0" * 64) == [("one.jsonl", None, "sha256")]


def test_first_error_and_raise(spark):
    d = tempfile.mkdtemp(prefix="val-")
    write(d, "x.jsonl", b'{"a": 1}\n{"b": 2}\nbad\n')
    rep = V.validate(spark, d, ["a"])
    assert ":2:" in V.first_error(rep) and "missing" in V.first_error(rep)
    with pytest.raises(V.ValidationError):
        V.raise_on_error(rep)
    ok = tempfile.mkdtemp(prefix="val-")
    write(ok, "y.jsonl", b'{"a": 1}\n\n{"a": 2}\n')
    assert V.record_count(spark, ok, ["a"]) == 2


def test_fast_mode_flags_structure(spark):
    d = tempfile.mkdtemp(prefix="val-")
    write(d, "x.jsonl", b'{"a": 1}\n[1]\n{"b": 1}\nnope\n')
    got = report(spark, d, ["a"], strict=False)
    assert [(l, c) for _, l, c in got] == [(2, "not_object"), (3, "missing_fields"), (4, "invalid_json")]


def _some_json(rng, depth):
    """A value that is mostly valid JSON."""
    k = rng.randrange(8 if depth else 6)
    if k == 0:
        return rng.choice(['"a\\n"', '"\\u00e9"', '"é😀"', '""', '"\\ud800"', '"\\x"', '"\t"', '"\\u12"'])
    if k == 1:
        return rng.choice(["0", "-0", "01", "1.5", "1.", "-", "1e5", "1E+07", ".5", "1e", "-1.25e-3", "9" * 400, "9" * 5000])
    if k == 2:
        return rng.choice(["true", "false", "null", "NaN", "Infinity", "-Infinity", "True", "nul"])
    if k < 6:
        return rng.choice(['"x"', "12"])
    gap = lambda: rng.choice(["", "", "", " ", "\x0b"])
    end = rng.choice(["", "", "", ","])
    if k == 6:
        return "[" + gap() + ",".join(_some_json(rng, depth - 1) + gap() for _ in range(rng.randrange(4))) + end + "]"
    names = [f'"k{rng.randrange(3)}"' for _ in range(rng.randrange(4))]
    return "{" + gap() + ",".join(n + gap() + ":" + gap() + _some_json(rng, depth - 1) for n in names) + end + "}"


def test_proof_in_the_jvm_agrees_with_the_parser(spark):
    rng = random.Random(5)
    lines = ['{"q":' + _some_json(rng, 5) + "}" + rng.choice([""] * 8 + [" x", "}"]) for _ in range(3000)]
    lines += [_some_json(rng, 4) for _ in range(500)]
    for i in range(0, len(lines), 7):
        j = rng.randrange(len(lines[i]) + 1)
        lines[i] = lines[i][:j] + rng.choice(['"', "\\", "{", "}", ",", " ", ""]) + lines[i][j + 1 :]
    lines += ['{"q":"' + "x\\n" * 300000 + '"}', '{"q":[' + "1," * 300000 + "1]}", "[" * 100000]
    df = spark.createDataFrame(list(enumerate(lines)), "i long, value string").repartition(4)
    for required in (None, ["q"], ["k0", "q"]):
        want = {(r.i, r.status, r.detail) for r in V.check_lines(df, required).filter("status <> 'ok'").collect()}
        assert {(r.i, r.status, r.detail) for r in V.failing_lines(df, required).collect()} == want
    ok = {r.i for r in V.check_lines(df).filter("status = 'ok'").collect()}
    proven = {r.i for r in df.filter(F.trim("value").rlike(V.json_object_pattern())).collect()}
    assert proven <= ok and len(proven) > 0.8 * len(ok)
    assert {len(lines) - 3, len(lines) - 2} <= proven


def test_many_small_splits_share_tasks(spark):
    """Splits of 4 KB: a task for each would grow with every 4 KB of text."""
    from quarry.plans import catalog

    sc = spark.sparkContext
    sc.setJobGroup("small-splits", "")
    try:
        assert catalog.validate_files_counts(spark, SF01).count() == 10
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    seen = sc.statusTracker()
    stages = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup("small-splits") for s in seen.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= 12  # 8 partitions; the files have 30 splits


def test_a_folder_with_files_is_found_by_one_task(spark):
    from quarry.sources.tables import has_files

    d = tempfile.mkdtemp(prefix="val-")
    for i in range(40):
        write(d, f"{i}.jsonl", b"x" * 5000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    sc = spark.sparkContext
    sc.setJobGroup("found", "")
    try:
        assert has_files(spark, d) and not has_files(spark, os.path.join(d, "none"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    seen = sc.statusTracker()
    stages = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup("found") for s in seen.getJobInfo(j).stageIds]
    assert sum(s.numTasks for s in stages if s) <= 1
