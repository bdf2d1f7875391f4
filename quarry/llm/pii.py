"""Personal data, and the terms that would reveal it, by information-theoretic sanitisation.

Protected entities are the e-mail addresses, IP addresses, card numbers and phone numbers found by pattern.
Masking them is not enough if other words of the text give them away. For an entity e and a term t, counted over the
different texts of the corpus (copies are one text), anywhere in them:

    IC(e) = log2(N / n(e))        information that e carries
    PMI(e, t) = log2(N n(e, t) / (n(e) n(t)))        information about e that t gives away

A term whose share PMI / IC reaches ``generalise`` is generalised to the class of its spelling (a name, a word, a number,
a code), one that reaches ``remove`` is removed: every occurrence of it, in every text that holds e. An entity that
stands in one text only is given away by all terms that are rare enough, as any of them leads to that text.

Of the texts only those with an entity are kept beside the counts. As n(e, t) <= n(e), a term can only disclose an entity
where n(t) <= N ** (1 - generalise) * n(e) ** generalise, so the common terms of a text never meet its entities.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bytes_of, fold, id_and_text, ready, slices, word_hashes, word_spans

KINDS = ("email", "ip", "card", "phone")
#: A term is a run of ASCII letters, digits and non-ASCII characters of so many bytes at least; A-Z folded.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[48:58] = TERM_BYTES[65:91] = TERM_BYTES[97:123] = TERM_BYTES[128:] = True
LEAST_BYTES = 3
#: Copied texts whose hashes are sent to all tasks; beyond that Spark joins them by shuffling.
MAX_BROADCAST_TEXTS = 1_000_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9][0-9.]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+ from each @ outwards, so that a long run costs one pass."""
    end, at = 0, text.find("@")
    while at >= 0:
        m, start = _DOMAIN.match(text, at + 1), at
        if m:
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                end = m.end()
        at = text.find("@", max(at + 1, end))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for block in _DOTTED.finditer(text):
        if text.count(".", block.start(), block.end()) >= 3:
            for m in _IP.finditer(text, block.start(), block.end()):
                parts = [p.lstrip("0") for p in m.group().split(".")]
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    # Runs of digits joined by single separators: the same matches, but for lone digits, which no rule keeps.
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of all base kinds, by kind, then start."""
    return [(k, a, z) for k, f in enumerate((_emails, _ips, _cards, _phones)) for a, z in f(text)]


def entity_of(kind: int, value: str) -> int:
    """The protected entity as a 64-bit number: spelling of separators and case don't matter."""
    plain = value.lower() if kind == 0 else value if kind == 1 else "".join(c for c in value if c.isdigit())
    return xxhash.xxh64_intdigest(f"{kind}:{plain}") - (1 << 63)


FOUND = "doc_id long, spans array<struct<kind:int,start:int,end:int>>, entities array<long>, text binary, th long"


def find_base(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: its base spans, its entities, its text if it has one, the hash of its text."""
    ready(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.int64())]
        for batch in batches:
            for b in slices(batch, "text"):
                spans, entities, texts = [], [], []
                for t in b.column("text"):
                    raw = t.as_py()
                    text = raw.decode()
                    s = base_spans(text)
                    spans.append([{"kind": k, "start": a, "end": z} for k, a, z in s])
                    entities.append(sorted({entity_of(k, text[a:z]) for k, a, z in s}))
                    texts.append(raw if s else None)
                cols = [b.column("doc_id"), pa.array(spans, types[0]), pa.array(entities, types[1]), pa.array(texts, pa.binary()), b.column("th")]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "spans", "entities", "text", "th"])

    return id_and_text(df, id_col, text_col).withColumn("th", F.xxhash64("text")).mapInArrow(run, FOUND)


def terms_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, first byte, end byte) of every term of some texts."""
    buf = fold(buf)
    starts, ends, first = word_spans(buf, off, TERM_BYTES)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    long = ends - starts >= LEAST_BYTES
    starts, ends = starts[long], ends[long]
    return doc[long], word_hashes(buf, starts, ends).view(np.int64), starts, ends


def hash_terms(words: list[bytes]) -> np.ndarray:
    """The hashes that ``terms_of`` gives these terms."""
    ends = np.cumsum([len(w) for w in words]) if words else np.zeros(0, np.int64)
    buf = fold(np.frombuffer(b"".join(words), np.uint8))
    return word_hashes(buf, ends - np.array([len(w) for w in words], np.int64), ends).view(np.int64)


def term_counts(texts: DataFrame) -> DataFrame:
    """(term, n_t): rows of (text binary) that hold each term; partial counts are added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            u, at = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
            return u, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        for batch in batches:
            for b in slices(batch, "text", 2 << 20):
                doc, terms, _, _ = terms_of(*bytes_of(b.column("text")))
                u, at = np.unique(terms, return_inverse=True)
                pairs = np.unique(doc * np.int64(max(1, len(u))) + at)
                held.append((u, np.bincount(pairs % max(1, len(u)), minlength=len(u))))
                if sum(len(t) for t, _ in held) > 600_000:
                    held[:] = [merged()]
                    if len(held[0][0]) > 400_000:  # bounded memory
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1])], ["term", "n"])
                        held.clear()
        if held:
            u, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n.astype(np.int64))], ["term", "n"])

    counted = texts.select("text").mapInArrow(run, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n_t"))


def _different(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """One row of each different text: the texts that stand once, and one of each that is copied. Only copies move."""
    copied = materialize(hashes.groupBy("th").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("th"))
    side = F.broadcast(copied) if copied.count() <= MAX_BROADCAST_TEXTS else copied
    docs = docs.select("text", F.xxhash64("text").alias("th"))
    once = docs.join(side, "th", "left_anti").select("text")
    return once.unionAll(docs.join(side, "th", "left_semi").groupBy("th").agg(F.any_value("text").alias("text")).select("text"))


def disclosing_terms(found: DataFrame, counts: DataFrame, generalise: float, remove: float) -> DataFrame:
    """(th, term, share): the terms of each text that give one of its entities away, and how much at most."""
    texts = found.filter("text is not null").groupBy("th").agg(F.any_value("text").alias("text"), F.any_value("entities").alias("entities"))
    held = materialize(texts.select("th", F.explode("entities").alias("entity")))
    n = F.lit(float(max(1, found.select("th").distinct().count())))
    n_e = materialize(held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).filter(F.col("n_e") < n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                doc, terms, _, _ = terms_of(*bytes_of(b.column("text")))
                pairs = np.unique(np.stack([doc, terms]), axis=1)
                yield pa.RecordBatch.from_arrays([b.column("th").take(pa.array(pairs[0])), pa.array(pairs[1])], ["th", "term"])

    # Per text the entity that stands in most texts bounds how common a term may be that gives any of them away.
    known = held.join(n_e, "entity")
    most = known.groupBy("th").agg(F.max("n_e").alias("most"))
    at_most = F.pow(n, F.lit(1 - generalise)) * F.pow(F.col("most"), F.lit(generalise)) * 1.000001
    terms = texts.select("th", "text").mapInArrow(run, "th long, term long").join(most, "th").join(counts, "term")
    rare = materialize(terms.filter(F.col("n_t") <= at_most).select("th", "term", "n_t"))

    def share(n_et):
        return F.log2(n * n_et / (F.col("n_e") * F.col("n_t"))) / F.log2(n / F.col("n_e"))

    # An entity of one text meets each term once, so its text's terms are decided by their counts alone.
    single = known.filter("n_e = 1").select("th", "n_e").distinct()
    alone = rare.join(single, "th").select("th", "term", share(F.lit(1)).alias("share"))
    several = known.filter("n_e > 1")
    both = rare.join(several, "th").groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"), F.any_value("n_e").alias("n_e"), F.any_value("n_t").alias("n_t"))
    both = both.withColumn("share", share(F.col("n_et"))).filter(F.col("share") >= generalise - 1e-9).select("entity", "term", "share")
    shared = rare.join(several, "th").join(both, ["entity", "term"]).select("th", "term", "share")
    out = alone.unionAll(shared).groupBy("th", "term").agg(F.max("share").alias("share"))
    return out.filter(F.col("share") >= generalise - 1e-9)


def find_personal_data(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    generalise: float = 0.8,
    remove: float = 0.95,
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, all_spans), one row per row of df.

    A span is kind:start:end in code points, end exclusive. base_sha256: of the base spans by kind, then start,
    joined by commas; spans: these and then every term of the text that was generalised or removed, as kinds
    generalised and removed, outside the base spans. all_spans: the same as structs. Null and empty texts have none;
    repeated rows and null ids get a row each, and equal texts count once; an empty table gives an empty result.
    """
    found = materialize(find_base(df, id_col, text_col))
    # The written rows have a fixed order, so the number is the same in every pass.
    found = found.withColumn("row", F.monotonically_increasing_id())
    counts = term_counts(_different(id_and_text(df, id_col, text_col), found.select("th")))
    terms = disclosing_terms(found, counts, generalise, remove)
    action = F.when(F.col("share") >= remove - 1e-9, 5).otherwise(4).cast("int")
    # Terms of one text, as many as it has at most.
    marks = terms.groupBy("th").agg(F.collect_list(F.struct("term", action.alias("kind"))).alias("marks"))
    marks = marks.select(F.col("th").alias("mark_th"), F.col("marks.term").alias("terms"), F.col("marks.kind").alias("kinds"))
    marked = found.filter("text is not null").join(marks, F.col("th") == F.col("mark_th"))
    extra = marked.select("row", "text", "spans", "terms", "kinds").mapInArrow(_spots, "r long, extra array<struct<kind:int,start:int,end:int>>")
    x = found.drop("text", "entities", "th").join(extra, F.col("row") == F.col("r"), "left")
    names = F.array(*[F.lit(k) for k in (*KINDS, "generalised", "removed")])

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    x = x.withColumn("all_spans", F.concat("spans", F.coalesce(F.array_sort("extra"), F.slice("spans", 1, 0))))

    def number(k: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")

    counts = [number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return x.select("doc_id", *counts, F.sha2(shown(F.col("spans")), 256).alias("base_sha256"), shown(F.col("all_spans")).alias("spans"), "all_spans")


def _spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row every occurrence of its text's disclosing terms outside its base spans, in code points."""
    kind_of = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        for b in slices(batch, "text"):
            buf, off = bytes_of(b.column("text"))
            doc, terms, starts, ends = terms_of(buf, off)
            # Code points before each byte: bytes that do not go on with a character.
            points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
            first, out = np.searchsorted(doc, np.arange(b.num_rows + 1)), []
            for i in range(b.num_rows):
                lo, hi = first[i], first[i + 1]
                marks = np.asarray(b.column("terms")[i].values).astype(np.int64)
                kinds = np.asarray(b.column("kinds")[i].values)
                order = np.argsort(marks)
                at = np.minimum(np.searchsorted(marks[order], terms[lo:hi]), len(marks) - 1)
                hit = np.flatnonzero(marks[order][at] == terms[lo:hi])
                s, e = (points[x[lo:hi][hit]] - points[off[i]] for x in (starts, ends))
                base = sorted((x["start"], x["end"]) for x in b.column("spans")[i].as_py())
                # The last base span that starts before a term's end is over by the term's start, or one before it is longer.
                begin, over = np.array([x for x, _ in base]), np.maximum.accumulate([x for _, x in base])
                k = np.searchsorted(begin, e) - 1
                free = (k < 0) | (over[np.maximum(k, 0)] <= s)
                got = zip(kinds[order][at][hit][free].tolist(), s[free].tolist(), e[free].tolist())
                out.append([{"kind": kd, "start": x, "end": z} for kd, x, z in got])
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, kind_of)], ["r", "extra"])


MASKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", None, "")


def term_class(term: str) -> str:
    """What a generalised term becomes: the class of its spelling, which nearly every text holds."""
    if term.isdigit():
        return "[NUMBER]"
    if any(c.isdigit() for c in term):
        return "[CODE]"
    return "[NAME]" if term[:1].isupper() else "[WORD]"


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each (kind, start, end) replaced by its mask or class; of overlapping spans the first and longest."""
    out, at = [], 0
    for kind, a, z in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            held = MASKS[kind]
            out += [text[at:a], term_class(text[a:z]) if held is None else held]
            at = z
    return "".join(out) + text[at:]


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, text), one row per row of df: texts with masked entities and without the terms that give them away.

    Rows are told apart by a number, so repeated rows stay and count as documents, as in find_personal_data.
    """
    ready(df)

    @F.pandas_udf("string")
    def masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
        shown = [[(KINDS_BY_NAME[k], int(a), int(z)) for k, a, z in (s.split(":") for s in x.split(",") if s)] for x in spans]
        return pd.Series([mask(t, s) for t, s in zip(texts, shown)])

    docs = materialize(id_and_text(df, id_col, text_col).select("doc_id", F.col("text").cast("string").alias("text")))
    # The written rows have a fixed order, so the number is the same in every pass.
    numbered = docs.withColumn("k", F.monotonically_increasing_id())
    spans = find_personal_data(numbered, "k", "text", **options).select(F.col("doc_id").alias("k"), "spans")
    return numbered.join(spans, "k").select("doc_id", masked("text", "spans").alias("text"))


KINDS_BY_NAME = {k: i for i, k in enumerate((*KINDS, "generalised", "removed"))}
