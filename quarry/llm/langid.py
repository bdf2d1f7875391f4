"""Language identification by rank-order profiles of character n-grams.

A language's profile is its ``profile_size`` most frequent n-grams (n = 1 to 3, within words), in order of
frequency. A document's most frequent n-grams are compared to each profile: an n-gram costs the distance
between its two ranks, or ``profile_size`` if the profile lacks it. The language with the least sum wins.

n-grams are counted over runs of letters in lower case (any other character ends a word; a word has a
space at both ends), as 63-bit codes in numpy, whole texts always. Ties are broken by code.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ready

SHIFT = 21  # bits of a code point
#: Profiles are kept by the driver and sent to tasks: profile_size rows a language. More languages are an error.
MAX_LANGUAGES = 2_000
_LETTER: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTER:
        table = np.zeros(0x110000, bool)
        table[[i for i in range(0x110000) if chr(i).isalpha()]] = True
        _LETTER.append(table)
    return _LETTER[0]


def _chunks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Parts of a long text, cut before a space (a word longer than size stays whole)."""
    i = 0
    while i < len(text):
        j = len(text) if len(text) - i <= size else text.find(" ", i + size)
        j = len(text) if j < 0 else j
        yield text[i:j]
        i = j


def _codes(text: str) -> np.ndarray:
    """All n-grams of the text, n = 1 to 3, as codes."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c = np.where(_is_letter()[c], c, 0)
    c = np.concatenate([[0], c, [0]])
    c = c[(c > 0) | np.concatenate([[True], c[:-1] > 0])]  # one 0 between words
    if len(c) < 3:
        return np.zeros(0, np.int64)
    if c[-1]:
        c = np.append(c, 0)
    two = (c[:-1] << SHIFT) | c[1:]
    three = ((two[:-1] << SHIFT) | c[2:])[c[1:-1] > 0]
    return np.concatenate([c[c > 0], two, three])


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes in ascending order, counts) of a whole text."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in _chunks(text):
        u, n = np.unique(_codes(part), return_counts=True)
        codes, counts = (u, n) if not len(codes) else merge_counts(codes, counts, u, n)
    return codes, counts


def merge_counts(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    return u, np.bincount(at, np.concatenate([na, nb])).astype(np.int64)


def top(codes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent codes, most frequent first, ties by code."""
    if len(counts) > 4 * k:
        low = np.partition(counts, len(counts) - k)[len(counts) - k]
        codes, counts = codes[counts >= low], counts[counts >= low]
    return codes[np.argsort(-counts, kind="stable")[:k]]


def learn_profiles(df: DataFrame, text_col: str = "text", lang_col: str = "lang", profile_size: int = 300) -> dict[str, list[int]]:
    """Profiles of the rows' languages, over all rows with text and language (null languages are skipped)."""
    ready(df)
    rows = df.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def flush(lang: str) -> pa.RecordBatch:
            u, n = _sum(held.pop(lang))
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(u)), pa.array(u), pa.array(n)], ["lang", "code", "n"])

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                parts = held.setdefault(lang, [])
                parts.append(ngram_counts(text))
                if len(parts) >= 128:
                    held[lang] = [_sum(parts)]
            if sum(len(p[0]) for x in held.values() for p in x) > 4_000_000:  # bounded memory; Spark adds the rest
                for lang in list(held):
                    yield flush(lang)
        for lang in list(held):
            yield flush(lang)

    counted = rows.filter("lang is not null and text is not null").mapInArrow(run, "lang string, code long, n long")
    sums = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # Two levels, so a language with very many n-grams is not one task's sort.
    first = Window.partitionBy("lang", F.pmod("code", F.lit(64))).orderBy(F.desc("n"), "code")
    then = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    best = sums.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= profile_size)
    best = materialize(best.withColumn("r", F.row_number().over(then)).filter(F.col("r") <= profile_size).select("lang", "code", "r"))
    if best.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out: dict[str, list[int]] = {}
    for r in sorted(best.collect(), key=lambda r: (r["lang"], r["r"])):
        out.setdefault(r["lang"], []).append(r["code"])
    return out


def _sum(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return u, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


class Profiles:
    """Profiles laid out for lookups: rank[i, l] of n-gram codes[i] in language l."""

    def __init__(self, profiles: dict[str, list[int]], profile_size: int = 300):
        self.langs, self.size = sorted(profiles), profile_size
        self.codes = np.unique(np.array([c for p in profiles.values() for c in p], np.int64))
        self.rank = np.full((len(self.codes), len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.rank[np.searchsorted(self.codes, np.array(profiles[lang], np.int64)), k] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): score is 1 less the out-of-place distance as a share of the largest possible."""
        codes, counts = ngram_counts(text) if text else (np.zeros(0, np.int64), None)
        if not len(codes) or not self.langs:
            return "und", 0.0
        mine = top(codes, counts, self.size)
        at = np.minimum(np.searchsorted(self.codes, mine), len(self.codes) - 1)
        rank = self.rank[at]
        cost = np.where((rank < 0) | (self.codes[at] != mine)[:, None], self.size, np.abs(rank - np.arange(len(mine))[:, None]))
        total = cost.sum(axis=0)
        best = int(total.argmin())
        return self.langs[best], 1.0 - float(total[best]) / (len(mine) * self.size)


def identify(df: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", profile_size: int = 300, out: str = "_language") -> DataFrame:
    """df with a column `out`: struct(lang_pred string, score double); other columns and all rows stay.

    `und` and 0 if the text is null or has no letter, or no language was learned. The text alone decides, so repeated
    rows get one answer each and the same; at equal distances the language that comes first by name wins. A text in
    which no n-gram is known has score 0. An empty table stays empty. `out` must not be a column of df.
    """
    if out in df.columns:
        raise ValueError(f"the table has a column {out}; name another with out=")
    ready(df)
    model = df.sparkSession.sparkContext.broadcast(profiles)

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = Profiles(model.value, profile_size)
        for texts in parts:
            yield pd.DataFrame([p.predict(t) for t in texts], columns=["lang_pred", "score"])

    return df.withColumn(out, predict(F.col(f"`{text_col}`").cast("string")))


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves 2 by 4; null ids are not held out."""
    crc = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def language_of_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", profile_size: int = 300, out: str = "_language") -> DataFrame:
    """df with `out`: struct(lang_pred, score), learned from the rows that are not held out and have an id.

    Rows without a language or a text teach nothing but are answered like others; with none to learn from, all are
    `und`. Repeated rows teach as often as they stand there. More than MAX_LANGUAGES languages are an error: a profile
    is 300 numbers, and every task holds all of them. Otherwise as ``identify``.
    """
    crc = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    profiles = learn_profiles(df.filter(crc % 4 != 2), text_col, lang_col, profile_size)
    return identify(df, profiles, text_col, profile_size, out)
