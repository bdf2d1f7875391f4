"""Repair against an exhaustive search over edits and against a plain search over (cost, audit) pairs."""

import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from quarry.llm import conversation_repair as C
from tests.conftest import SF01

PATTERN = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    """The rows of each conversation after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        held = out.setdefault(conv, [])
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        held += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, v in out.items()}


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least (cost, audit, turns) by a forward search that keeps the least audit string of each state."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(states):
        for _ in range(3):
            for s, (cost, audit, made) in list(states.items()):
                for x in "ua":
                    t = step.get((s, x))
                    new = (cost + 2, audit + "I", (*made, (name[x], "")))
                    if t and (t not in states or new[:2] < states[t][:2]):
                        states[t] = new
        return states

    states = {"": (0, "", ())}
    for (_, role, text), what in zip(rows, faults):
        after = {}

        def offer(s, new):
            if s not in after or new[:2] < after[s][:2]:
                after[s] = new

        for s, (cost, audit, made) in inserted(states).items():
            offer(s, (cost + 3, audit + "D", made))
            if what in ("blank", "duplicate"):
                continue
            more = what == "truncated"
            if (s, role[:1]) in step:
                offer(step[s, role[:1]], (cost + more, audit + "K", (*made, (role, text))))
            for x in "ua":
                if (s, x) in step:
                    offer(step[s, x], (cost + 2 + more, audit + "R", (*made, (name[x], text))))
        states = after
    return min((states[s] for s in inserted(states) if s in ("", "a")), key=lambda x: x[:2])


def exhaustive(rows, faults):
    """The same by trying everything; for a few rows."""
    best = None
    ways = []
    for (_, role, text), what in zip(rows, faults):
        more = what == "truncated"
        own = [(3, "D", None)]
        if what not in ("blank", "duplicate"):
            own += [(more, "K", (role, text)), (2 + more, "R", ("user", text)), (2 + more, "R", ("assistant", text))]
        ways.append(own)
    gaps = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for edits in itertools.product(*ways):
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, made = 0, "", []
            for i in range(len(rows) + 1):
                cost, audit = cost + 2 * len(ins[i]), audit + "I" * len(ins[i])
                made += [(r, "") for r in ins[i]]
                if i < len(rows):
                    c, letter, row = edits[i]
                    cost, audit = cost + c, audit + letter
                    made += [row] if row else []
            if PATTERN.fullmatch("".join(r[:1] or "?" for r, _ in made)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, tuple(made))
    return best


def brute(rows):
    out = []
    for conv, held in damaged(rows).items():
        faults = faults_of(held)
        cost, audit, made = cheapest(held, faults)
        turns = {t for t, _, _ in held} - {None}
        bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *[faults.count(x) for x in ("blank", "duplicate", "truncated")], bad, cost, audit, sha))
    return sorted(map(str, out))


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "human", "", None, "unit"]
    texts = ["Yes.", "No!", "a b", " ", None, "same", "Why?  ", "é　", "tail.\n"]
    rows = []
    for conv in range(convs):
        for _ in range(rng.randint(1, most)):
            turn = rng.choice([None, *range(-2, most)])
            rows.append((conv if conv else None, turn, rng.choice(roles), rng.choice(texts)))
    return rows


def report(spark, rows, **columns):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"conv": F.lit("x"), "gone": F.lit(1), "times": F.lit(2), "col": F.lit(3), **columns})
    return C.repair_conversations(C.damage(df))


def test_the_plain_search_is_exhaustive():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(0, 3)
        rows = [(0, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["A.", "b", " ", "C."])) for _ in range(n)]
        assert cheapest(rows, faults_of(rows)) == exhaustive(rows, faults_of(rows))


def test_graph_against_plain_search():
    rng = random.Random(6)
    for _ in range(300):
        rows = [(0, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["A.", "b", " ", "C.", "D!"])) for _ in range(rng.randint(0, 12))]
        faults = faults_of(rows)
        g = C.Graph([(r[:1], f) for (_, r, _), f in zip(rows, faults)])
        best = g.solve(g.final())[0][C.START]
        cost, audit, made = cheapest(rows, faults)
        assert (g.cost(best), g.audit(best).decode()) == (cost, audit)
        assert tuple((r, t) for r, t, _ in C.apply_audit(g.audit(best), [(r, t) for _, r, t in rows])) == made


def test_odd_rows(spark):
    rows = random_rows(1, 150, 9)
    got = report(spark, rows)
    assert got.columns == ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)
    assert report(spark, rows[:1] * 0 or [rows[0]]).limit(0).count() == 0
    assert C.repair_conversations(C.damage(spark.createDataFrame([], SCHEMA))).count() == 0


def test_long_conversations_are_chained(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 3)
    rows = random_rows(2, 40, 30) + [(99, i, "user" if i % 3 else "assistant", f"t{i % 50}{'.' * (i % 2)}") for i in range(400)]
    got = report(spark, rows)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


def test_long_conversation_at_the_real_chunk(spark):
    rng = random.Random(3)
    rows = [(7, i, rng.choice(["user", "assistant", "tool"]), f"text {i % 700}{rng.choice(['.', ''])} {'x' * 50}") for i in range(2000)]
    rows += [(8, 0, "user", "Hi."), (8, 1, "assistant", "Ho.")]
    assert sorted(str(tuple(r)) for r in report(spark, rows).collect()) == brute(rows)


def test_turns_of_long_and_short_ones(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 4)
    rows = random_rows(4, 30, 20)
    got = {}
    for r in C.repaired_turns(C.damage(spark.createDataFrame(rows, SCHEMA))).orderBy("position").collect():
        got.setdefault(r.conv, []).append((r.role, r.text))
    want = {c: list(cheapest(v, faults_of(v))[2]) for c, v in damaged(rows).items()}
    assert got == {c: v for c, v in want.items() if v}


def test_the_table(spark):
    table = spark.read.parquet(f"{SF01}/conversations.parquet")
    got = C.repair_conversations(C.damage(table))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
