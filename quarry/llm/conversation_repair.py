"""Repair of the structure of conversations by a shortest path with big-integer weights.

The rows of a conversation, in turn order, are edited (kept, given another role, deleted) and empty turns are
inserted so that the roles read ``(s?(ua)+)?``: nothing, or an optional system turn and then user and assistant
in turns. The cheapest edits win; among equal costs the one whose audit, the initials of the edits in order, is
least in ASCII.

Both are decided by one integer minimum. A weight is ``cost`` in the high digits and the audit letters in the low
ones: WIDTH positional digits of eight bits, the first letter in the highest, zero after the end. The graph has a
node for each row and state of the pattern; inserted turns stand before the row that they precede, so edges only
lead forward, and the value of a node is the least of its edges.

A conversation of at most ``CHUNK`` rows is one such graph, solved in the task that holds its rows. A longer one is
cut into chunks of ranked rows, spread over all tasks: a chunk is solved from each state to each state, the chunks'
small tables of costs are chained per conversation, and the chosen paths are written out chunk by chunk again.
Audits of one chunk from one state never are a prefix of each other (all end with the letter of the same row), so
their order within the chunk is enough to chain them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.order import join_null_safe, ordinal_rank
from ..session import materialize
from .common import WS_CHARS as WS
from .common import ready, tasks

#: Rows of a graph.
CHUNK = 256
#: A big conversation's key is sent to all tasks up to so many of them; beyond that Spark joins by shuffling.
MAX_BROADCAST_KEYS = 1_000_000

KEEP, REROLE, DELETE, INSERT = b"KRDI"
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a turn whose role has that initial.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: What a new role or an inserted turn can lead to; only these two roles are given.
TURNS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAME = {USER: "user", ASSISTANT: "assistant"}
ENDS = (START, ASSISTANT)
#: More inserted turns than two before one row only add cost.
MOST_INSERTED = 2

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
DAMAGE = {"drop": 0, "empty": 1, "unpunctuate": 2, "repeat": 3, "to_user": 4}


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", modulus: int = 20) -> DataFrame:
    """(conv, turn, role, text, gone): the rows with the faults that crc32 of "conv:turn" gives them.

    0 of `modulus` drops a row (it stays here with gone = true, so that its conversation is not lost), 1 empties its
    text, 2 takes its sentence ends away, 3 repeats it, 4 makes it the user's. Null values are one space."""
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`").cast("long")
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    k = F.pmod(F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")), F.lit(modulus))
    role, text = space(F.col(f"`{role_col}`")), space(F.col(f"`{text_col}`"))
    role = F.when(k == DAMAGE["to_user"], "user").otherwise(role)
    text = F.when(k == DAMAGE["empty"], "").when(k == DAMAGE["unpunctuate"], F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(k == DAMAGE["repeat"], F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    x = df.select(conv.alias("conv"), turn.alias("turn"), role.alias("role"), text.alias("text"), (k == DAMAGE["drop"]).alias("gone"), times.alias("times"))
    return x.select("conv", "turn", "role", "text", "gone", F.explode("times")).drop("col")


# ---- one graph ------------------------------------------------------------------------------------


def fault(role: str, text: str, seen: bool) -> str | None:
    """The first fault of a row."""
    body = text.strip(WS)
    if not body:
        return BLANK
    if seen:
        return DUPLICATE
    return None if body[-1] in ".!?" else TRUNCATED


class Graph:
    """The cheapest edits of some rows, from any state to given end states.

    `rows` are (initial of the role, fault). `ends` maps an end state to what must be inserted after the last row, so
    a conversation's last chunk ends in an accepted state; a chunk before it has none."""

    def __init__(self, rows: list[tuple[str, str | None]]):
        self.rows = rows
        self.width = 8 * ((MOST_INSERTED + 1) * len(rows) + MOST_INSERTED)
        self.top, self.low = self.width - 8, (1 << self.width) - 1

    def _before(self, value: int, letter: int, cost: int) -> int:
        """The weight of a path with one more edge at its start."""
        return ((value >> self.width) + cost << self.width) | letter << self.top | (value & self.low) >> 8

    def solve(self, ends: dict[int, int]) -> list[list[int | None]]:
        """values[i][state]: least weight from before row i to an end, None where there is no path."""
        values: list[list[int | None]] = [[ends.get(s) for s in range(4)]]
        for initial, what in reversed(self.rows):
            after, here = values[-1], [None] * 4
            more = TRUNCATED_COST if what == TRUNCATED else 0
            for state in range(4):
                best = None if after[state] is None else self._before(after[state], DELETE, DELETE_COST)
                if what not in (BLANK, DUPLICATE):
                    kept = NEXT.get((state, initial))
                    for to, letter, cost in ((kept, KEEP, KEEP_COST), (TURNS[state], REROLE, REROLE_COST)):
                        if to is not None and after[to] is not None:
                            w = self._before(after[to], letter, cost + more)
                            best = w if best is None or w < best else best
                here[state] = best
            for _ in range(MOST_INSERTED):
                for state, to in ((s, TURNS[s]) for s in (START, SYSTEM, USER, ASSISTANT)):
                    if here[to] is not None:
                        w = self._before(here[to], INSERT, INSERT_COST)
                        here[state] = w if here[state] is None or w < here[state] else here[state]
            values.append(here)
        return values[::-1]

    def cost(self, value: int) -> int:
        return value >> self.width

    def audit(self, value: int) -> bytes:
        return (value & self.low).to_bytes(self.width // 8, "big").rstrip(b"\0")

    def final(self) -> dict[int, int]:
        """End weights of the last rows: what is inserted after them."""
        out = {s: 0 for s in ENDS}
        out[USER] = self._before(0, INSERT, INSERT_COST)
        out[SYSTEM] = self._before(out[USER], INSERT, INSERT_COST)
        return out


def apply_audit(audit: bytes, rows: list[tuple[str, str]], state: int = START) -> list[tuple[str, str, str]]:
    """(role, text, letter) of the turns that the edits make of the rows, from a state on."""
    out, left = [], iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == INSERT else next(left)
        if letter == DELETE:
            continue
        if letter == KEEP:
            state = NEXT[(state, role[:1])]
        else:
            state = TURNS[state]
            role = NAME[state]
        out.append((role, text, chr(letter)))
    return out


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


# ---- rows of a partition, group by group ---------------------------------------------------------


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """(key, rows) of each run of rows with one key; the partition is sorted by it."""
    at, held = None, []
    for b in batches:
        for row in b.to_pylist():
            key = tuple(row[k] for k in keys)
            if held and key != at:
                yield at, held
                held = []
            at = key
            held.append(row)
    if held:
        yield at, held


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 500, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(v) for v in r if isinstance(v, (str, bytes)))
        if len(held) == most or size > most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _map(df: DataFrame, fields: str, make: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], conv_type: T.DataType) -> DataFrame:
    """Rows (conv, *fields) that `make` yields for a partition."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("conv", conv_type), *T._parse_datatype_string(fields).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(make(batches), arrow)

    return df.mapInArrow(run, schema)


def _by_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    # Conversations of any number are dealt out; AQE does not merge what a number is given for.
    return df.repartition(tasks(df.sparkSession), *keys).sortWithinPartitions(*keys, *order)


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURN = "position long, role string, text string, edit string"


def _counts(faults: list[str | None]) -> tuple[int, int, int]:
    return faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED)


def _short(with_turns: bool) -> Callable:
    """Conversations of at most CHUNK rows, whole; one without rows is named by a row that is gone."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), all_rows in grouped(batches, ["conv"]):
            rows = [r for r in all_rows if not r["gone"]]
            pairs = [(r["role"], r["text"]) for r in rows]
            seen, faults = set(), []
            for pair in pairs:
                faults.append(fault(*pair, pair in seen))
                seen.add(pair)
            graph = Graph([(role[:1], what) for (role, _), what in zip(pairs, faults)])
            best = graph.solve(graph.final())[0][START]
            audit = graph.audit(best)
            made = apply_audit(audit, pairs)
            if with_turns:
                yield from ((conv, i, *turn) for i, turn in enumerate(made))
                continue
            turns = {r["turn"] for r in rows} - {None}
            gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
            text = "\n".join(f"{role}:{text}" for role, text, _ in made)
            yield (conv, gaps, *_counts(faults), illegal([role[:1] for role, _ in pairs]), graph.cost(best), audit.decode(), hashlib.sha256(text.encode()).hexdigest())

    return make


# ---- long conversations ---------------------------------------------------------------------------


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per chunk: counts, the initials at its ends, and for each pair of states the cost and the order of the audit."""
    for (conv, chunk), rows in grouped(batches, ["conv", "chunk"]):
        faults = [fault(r["role"], r["text"], r["rank"] != r["first"]) for r in rows]
        initials = [r["role"][:1] for r in rows]
        graph = Graph(list(zip(initials, faults)))
        found = [graph.solve({to: 0})[0] for to in range(4)]
        costs, orders = [], []
        for state in range(4):
            values = [found[to][state] for to in range(4)]
            audits = sorted(graph.low & v for v in values if v is not None)
            costs += [-1 if v is None else graph.cost(v) for v in values]
            orders += [-1 if v is None else audits.index(graph.low & v) for v in values]
        yield conv, chunk, *_counts(faults), illegal(initials), initials[0], initials[-1], costs, orders


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """The states between the chunks of a conversation, from its last chunk backwards."""
    pdf = pdf.sort_values("chunk")
    best, picks = [(Graph([]).cost(v), 0) for _, v in sorted(_last_weights().items())], []
    for costs, orders in zip(pdf["costs"].tolist()[::-1], pdf["orders"].tolist()[::-1]):
        here, pick = [], []
        for state in range(4):
            ways = [(costs[4 * state + to] + best[to][0], orders[4 * state + to], to) for to in range(4) if costs[4 * state + to] >= 0]
            least = min(ways)
            here.append((least[0], 0))
            pick.append(least[2])
        best = here
        picks.append(pick)
    state, states = START, []
    for pick in picks[::-1]:
        states.append((state, pick[state]))
        state = pick[state]
    first, last = pdf["first"].tolist(), pdf["last"].tolist()
    seams = [0] + [int(a + b not in ("su", "ua", "au")) for a, b in zip(last, first[1:])]
    return pdf[["conv", "chunk", "blank", "duplicate", "truncated"]].assign(
        illegal=pdf["illegal"].to_numpy() + seams, cost=best[START][0], state=[s for s, _ in states], to=[t for _, t in states], is_last=[False] * (len(pdf) - 1) + [True]
    )


def _last_weights() -> dict[int, int]:
    return Graph([]).final()


def _pieces(with_turns: bool) -> Callable:
    """Per chunk the edits between the states that were chosen, and what they make of its rows."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv, chunk), rows in grouped(batches, ["conv", "chunk"]):
            pairs = [(r["role"], r["text"]) for r in rows]
            graph = Graph([(r["role"][:1], fault(r["role"], r["text"], r["rank"] != r["first"])) for r in rows])
            state, to = rows[0]["state"], rows[0]["to"]
            audit = graph.audit(graph.solve({to: 0})[0][state])
            if rows[0]["is_last"]:
                audit += bytes([INSERT]) * {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}[to]
            made = apply_audit(audit, pairs, state)
            if with_turns:
                # Room for all turns that chunks before this one can have made.
                yield from ((conv, chunk * (MOST_INSERTED + 1) * CHUNK + i, *turn) for i, turn in enumerate(made))
            else:
                yield conv, chunk, audit.decode(), len(made), "\n".join(f"{role}:{text}" for role, text, _ in made).encode()

    return make


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """SHA-256 of each conversation's pieces in order. The digest goes through a conversation's text from its start to
    its end, so one task reads it, piece by piece; only the digest and the audit are held."""
    at, state = None, None
    for b in batches:
        for r in b.to_pylist():
            if state is None or r["conv"] != at:
                if state is not None:
                    yield at, "".join(state[2]), state[0].hexdigest()
                at, state = r["conv"], [hashlib.sha256(), False, []]
            state[2].append(r["audit"])
            if r["lines"]:
                state[0].update((b"\n" if state[1] else b"") + r["piece"])
                state[1] = True
    if state is not None:
        yield at, "".join(state[2]), state[0].hexdigest()


def _big(x: DataFrame) -> tuple[DataFrame, int]:
    """The conversations of more than CHUNK rows."""
    big = materialize(x.filter(~F.col("gone")).groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CHUNK).select(F.col("conv").alias("big")))
    return big, big.count()


def _ranked(x: DataFrame) -> DataFrame:
    """The rows of long conversations with rank, chunk and the rank at which their role and text stand first."""
    rows = ordinal_rank(x.drop("gone"), ["conv"], ["turn", "role", "text"])
    rows = rows.withColumn("same", F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    # A text in a third of the rows meets in partial minima; the few values that repeat come back by a join.
    firsts = rows.groupBy("conv", "same").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    firsts = firsts.select(F.col("conv").alias("conv_"), F.col("same").alias("same_"), "first")
    same = F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("same") == F.col("same_"))
    rows = rows.join(firsts, same, "left").withColumn("first", F.coalesce("first", "rank"))
    return rows.select("conv", "turn", "role", "text", "rank", "first", F.floor((F.col("rank") - 1) / CHUNK).cast("long").alias("chunk"))


def _repair(df: DataFrame, with_turns: bool) -> DataFrame:
    ready(df)
    conv_type = df.schema["conv"].dataType
    big, n = _big(df)
    side = F.broadcast(big) if n <= MAX_BROADCAST_KEYS else big
    known = F.col("conv").eqNullSafe(F.col("big"))
    out = TURN if with_turns else f"{REPORT}, repaired_sha256 string"
    few = df if not n else df.join(side, known, "left_anti")
    # Of the rows that are gone one a conversation is enough, without its text.
    names = few.filter("gone").select("conv").distinct()
    names = names.select("conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(True).alias("gone"))
    few = few.filter(~F.col("gone")).unionByName(names)
    short = _map(_by_key(few, ["conv"], "turn", "role", "text"), out, _short(with_turns), conv_type)
    if not n:
        return short
    rows = materialize(_ranked(df.join(side, known, "left_semi").filter(~F.col("gone"))))
    table = "chunk long, blank long, duplicate long, truncated long, illegal long, first string, last string, costs array<long>, orders array<int>"
    chunks = materialize(_map(_by_key(rows, ["conv", "chunk"], "rank"), table, _tables, conv_type))
    chain = "chunk long, blank long, duplicate long, truncated long, illegal long, cost long, state int, to int, is_last boolean"
    schema = T.StructType([T.StructField("conv", conv_type), *T._parse_datatype_string(chain).fields])
    paths = materialize(chunks.groupBy("conv").applyInPandas(_chain, schema))
    chosen = join_null_safe(rows, paths.select("conv", "chunk", "state", "to", "is_last"), ["conv", "chunk"])
    chosen = _by_key(chosen, ["conv", "chunk"], "rank")
    if with_turns:
        return short.unionByName(_map(chosen, TURN, _pieces(True), conv_type))
    pieces = _map(chosen, "chunk long, audit string, lines long, piece binary", _pieces(False), conv_type)
    whole = _map(_by_key(pieces, ["conv"], "chunk"), "audit string, repaired_sha256 string", _digests, conv_type)
    sums = paths.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.max("cost").alias("cost"))
    turns = rows.groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    long = join_null_safe(join_null_safe(sums, turns, ["conv"]), whole, ["conv"])
    return short.unionByName(long.select(*short.columns))


def repair_conversations(df: DataFrame) -> DataFrame:
    """One row a conversation: faults, cost of the repair, its audit and the digest of what it makes.

    `df` has conv, turn (long), role, text and gone, as ``damage`` gives them; rows that are gone only name their
    conversation. The rows of a conversation are taken by turn, nulls first, ties by role and then text in code point
    order; equal rows are duplicates. Null conv ids are one conversation. A blank or repeated row is deleted. A
    conversation without rows has zeros, an empty audit and the digest of an empty string. An empty table stays
    empty; other columns are ignored."""
    x = df.select("conv", F.col("turn").cast("long").alias("turn"), *_texts(df))
    return _repair(x, with_turns=False)


def repaired_turns(df: DataFrame) -> DataFrame:
    """(conv, position, role, text, edit) of the repaired turns of every conversation, for the same rows.

    Positions grow along a conversation, not always by one. A repair that leaves no turn has no row."""
    x = df.select("conv", F.col("turn").cast("long").alias("turn"), *_texts(df))
    return _repair(x, with_turns=True)


def _texts(df: DataFrame) -> list[Column]:
    return [*[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], F.coalesce("gone", F.lit(False)).alias("gone")]
