"""Secret scan over a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: every match must contain some
of them. A task indexes its texts slice by slice: postings map each trigram that occurs in a query to the
documents holding it. Queries intersect and unite postings; only the candidates meet the regular expression.
A rule without mandatory trigrams scans every text. Trigrams are of bytes with A-Z folded, so a candidate may be
false but none is missed. The index is built where the text is, so no text or posting crosses the network.
"""

import hashlib
import re
from collections.abc import Iterator
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bytes_of, fold, id_and_text, ready, slices

# ---- FIXED VALUES: kinds in the order of results, pattern, flags, smallest length of a group ----------
BASE = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, 2, 6),
    # The runs below are maximal, so a smallest length within the pattern finds the same matches.
    ("access", r"AKIA[A-Z0-9]{16,}", re.ASCII, 0, 20),
    ("hex", r"[0-9a-f]{24,}", re.ASCII, 0, 24),
)
#: Kinds that the operator adds: public formats of keys and tokens.
MORE = (
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", re.ASCII, 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", re.ASCII, 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", re.ASCII, 0, 0),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", re.ASCII, 0, 0),
    ("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", re.ASCII, 0, 0),
)

ALL = ("all",)  # the query that every text satisfies
MOST_STRINGS = 64


# ---- Boolean trigram queries ---------------------------------------------------------------------


def _and(a, b):
    return b if a == ALL else a if b == ALL or a == b else ("and", a, b)


def _or(parts: list):
    if not parts or ALL in parts:
        return ALL
    return parts[0] if len(set(parts)) == 1 else ("or", *dict.fromkeys(parts))


def _strings(exact: set[bytes]):
    """Some string of the set occurs: all its trigrams do."""
    out = []
    for s in sorted(exact):
        q = ALL
        for i in range(len(s) - 2):
            q = _and(q, s[i : i + 3])
        out.append(q)
    return _or(out)


def _letter(code: int) -> bytes:
    return chr(code + 32 if 65 <= code <= 90 else code).encode()


def _sequence(items) -> tuple[set[bytes] | None, tuple]:
    """(the strings it matches, if they are few; a query that its matches satisfy)."""
    run, query, exact = {b""}, ALL, True
    for op, arg in items:
        e, q = _item(op, arg)
        if e is not None and len(run) * len(e) <= MOST_STRINGS:
            run = {a + b for a in run for b in e}
            continue
        query, exact = _and(_and(query, _strings(run)), q), False
        run = e if e is not None else {b""}
    return (run, _strings(run)) if exact else (None, _and(query, _strings(run)))


def _item(op, arg) -> tuple[set[bytes] | None, tuple]:
    if op is C.LITERAL:
        return {_letter(arg)}, ALL
    if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
        return {b""}, ALL
    if op is C.IN:
        chars: set[bytes] = set()
        for kind, x in arg:
            if kind is C.LITERAL:
                chars.add(_letter(x))
            elif kind is C.RANGE and x[1] - x[0] < 16:
                chars |= {_letter(y) for y in range(x[0], x[1] + 1)}
            else:
                return None, ALL
        return (chars, ALL) if len(chars) <= 8 else (None, ALL)
    if op is C.BRANCH:
        found = [_sequence(x) for x in arg[1]]
        if all(e is not None for e, _ in found) and sum(len(e) for e, _ in found) <= MOST_STRINGS:
            return set().union(*(e for e, _ in found)), ALL
        return None, _or([q for _, q in found])
    if op is C.SUBPATTERN:
        return _sequence(arg[3])
    if op is C.ATOMIC_GROUP:
        return _sequence(arg)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        low, high, inner = arg
        e, q = _sequence(inner)
        if low == 0:
            return (e | {b""}, ALL) if high == 1 and e is not None else (None, ALL)
        return (e, q) if low == high == 1 else (None, q if e is None else _strings(e))
    return None, ALL


def trigram_query(pattern: str, flags: int = 0):
    """A Boolean query (trigram, ("and", ...), ("or", ...) or ALL) that every text with a match satisfies."""
    return _sequence(_parser.parse(pattern, flags))[1]


def trigrams_of(query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set().union(*(trigrams_of(x) for x in query[1:])) if len(query) > 1 else set()


# ---- the index of a slice -------------------------------------------------------------------------


class Index:
    """Postings of the trigrams in `wanted` over one slice of texts."""

    def __init__(self, wanted: list[bytes]):
        self.number = {t: i + 1 for i, t in enumerate(wanted)}
        self.lookup = np.zeros(1 << 24, np.uint16)
        for t, i in self.number.items():
            self.lookup[t[0] << 16 | t[1] << 8 | t[2]] = i
        self.docs, self.postings = 0, {}

    def build(self, buf: np.ndarray, off: np.ndarray) -> None:
        self.docs, self.postings = len(off) - 1, {}
        if len(buf) < 3:
            return
        b = fold(buf).astype(np.uint32)
        hit = self.lookup[b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]]
        pos = np.flatnonzero(hit)
        doc = np.searchsorted(off, pos, "right") - 1
        whole = pos + 3 <= off[doc + 1]
        keys = np.unique(hit[pos[whole]].astype(np.int64) * self.docs + doc[whole])
        gram = keys // self.docs
        cut = np.searchsorted(gram, np.arange(1, len(self.number) + 2))
        self.postings = {i: keys[cut[i - 1] : cut[i]] - i * self.docs for i in self.number.values()}

    def find(self, query) -> np.ndarray:
        """Documents that satisfy the query, ascending."""
        if query == ALL:
            return np.arange(self.docs)
        if isinstance(query, bytes):
            return self.postings.get(self.number[query], np.zeros(0, np.int64))
        parts = [self.find(x) for x in query[1:]]
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
        return out


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple = MORE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row per row of df.

    A span is kind:start:end of a whole match, in code points, end exclusive; spans are sorted by start, then
    kind, and joined by commas: the base kinds and those of `more`. base_sha256 is of the base spans alone.
    Null and empty texts have none. Repeated rows and null ids get a row each; other columns are ignored.
    """
    ready(df)
    rules = [*BASE, *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(kind, re.compile(p, flags), group, least) for kind, p, flags, group, least in rules]
        queries = [trigram_query(p, flags) for _, p, flags, _, _ in rules]
        index = Index(sorted(set().union(*(trigrams_of(q) for q in queries))))
        for batch in batches:
            for b in slices(batch, "text"):
                index.build(*bytes_of(b.column("text")))
                texts = [t.as_py().decode() for t in b.column("text")]
                found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                for k, ((_, regex, group, least), query) in enumerate(zip(compiled, queries)):
                    for d in index.find(query).tolist():
                        for m in regex.finditer(texts[d]):
                            if m.end(group) - m.start(group) >= least:
                                found[d].append((m.start(), k, m.end()))
                out: list[list] = [[] for _ in range(5)]
                for spans in found:
                    spans.sort()
                    for k in range(3):
                        out[k].append(sum(s[1] == k for s in spans))
                    show = [(k, f"{rules[k][0]}:{a}:{z}") for a, k, z in spans]
                    out[3].append(hashlib.sha256(",".join(s for k, s in show if k < len(BASE)).encode()).hexdigest())
                    out[4].append(",".join(s for _, s in show))
                cols = [b.column("doc_id"), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string()), pa.array(out[4], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return id_and_text(df, id_col, text_col).mapInArrow(run, schema)
