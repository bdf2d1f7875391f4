"""Encoding of whole Arrow batches by the tokenizers library.

With the default tokenizer (white space dropped, every other rule local to a run of non-space characters) the
ids of a text are the ids of its space-separated words, one after the other. Words repeat far more than
texts, so each Python worker has every word encoded by the library once and keeps its ids in a bounded
table that outlives the batch and the task; batches then are lookups and gathers in numpy. A word of plain letters
is one piece of the tokenizer, so the library's model encodes it without the steps before it. A vocabulary file whose
steps are not known to allow this has its texts encoded whole.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import bytes_of, word_hashes

SEPARATOR = "<|startoftext|>"
#: Words kept per worker; the table starts anew beyond it. About 80 bytes a word.
MAX_WORDS = 1_500_000

#: FIXED VALUES - the steps before the model with which a text is the sum of its words.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters that are their own NFC form and have a lower case of one letter.
PLAIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"


def vocabulary() -> str:
    """Place of the default vocabulary file; every function below takes another path as well."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _is_sum_of_words(steps: dict) -> bool:
    """Whether the file's steps before its model are the known ones."""
    before = steps.get("pre_tokenizer") or {}
    split, level = (before.get("pretokenizers") or [{}, {}])[:2] if before.get("type") == "Sequence" else ({}, {})
    known = (steps.get("normalizer") or {}).get("normalizers") == NORMALIZERS and split.get("pattern") == {"Regex": PIECES}
    known = known and (split.get("behavior"), split.get("invert")) == ("Removed", True) and level.get("type") == "ByteLevel"
    return known and not level.get("add_prefix_space") and not level.get("use_regex") and steps["model"]["type"] == "BPE"


class WordEncoder:
    """ids of many texts at once; equal to encoding each text whole with add_special_tokens=False."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.max_words = Tokenizer.from_file(path), max_words
        self.model, self.separator = self.tokenizer.model, self.tokenizer.token_to_id(SEPARATOR)
        with open(path, encoding="utf-8") as f:
            self.by_word = self.separator is not None and _is_sum_of_words(json.load(f))
        if self.by_word:
            letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
            self.letters = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters})
            self._clear()

    def _clear(self) -> None:
        """The table: sorted hashes with the word of each, the words, and their ids one after the other."""
        self.hashes, self.word = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.words, self.odd = pa.array([], pa.large_string()), {}
        self.pool = np.zeros(1 << 16, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.n = 0

    def _append(self, flat: list[int], lens: list[int]) -> int:
        """Keep the ids of further words; the number of the first of them."""
        first, used = self.n, int(self.start[self.n])
        while used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[used : used + len(flat)] = flat
        while first + len(lens) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.start[first + 1 : first + 1 + len(lens)] = used + np.cumsum(lens)
        self.n += len(lens)
        return first

    def _ids(self, words: list[str]) -> list[list[int]]:
        """The ids of words by the library's whole way, many words a call."""
        out = []
        for i in range(0, len(words), 512):
            part = words[i : i + 512]
            if any(SEPARATOR in w for w in part):
                out += [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                continue
            held: list[int] = []
            for x in self.tokenizer.encode_batch_fast([SEPARATOR.join(part)], add_special_tokens=False)[0].ids:
                if x == self.separator:
                    out.append(held)
                    held = []
                else:
                    held.append(x)
            out.append(held)
        return out

    def _learn(self, words: pa.Array) -> int:
        """Append the words' ids to the table; the number of the first of them."""
        plain = np.asarray(pc.match_substring_regex(words, f"^[{PLAIN_LETTERS}]+$"), bool)
        known, tokenize, letters = words.to_pylist(), self.model.tokenize, self.letters
        rest = iter(self._ids([w for w, p in zip(known, plain.tolist()) if not p]))
        flat, lens = [], []
        for w, p in zip(known, plain.tolist()):
            if p:
                w = w.lower()
                ids = [t.id for t in tokenize(w if w.isascii() else w.translate(letters))]
            else:
                ids = next(rest)
            flat += ids
            lens.append(len(ids))
        return self._append(flat, lens)

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The table's number of each of some different words, which are learned where they are new."""
        if self.n + len(words) > self.max_words:
            self._clear()
        buf, off = bytes_of(words)
        h = word_hashes(buf, off[:-1], off[1:])
        new = ~self._known(h)[0]
        if new.any():
            # Of new words with one hash the first is kept in the table.
            some, first = np.unique(h[new], return_index=True)
            fresh = words.take(pa.array(np.flatnonzero(new)[first]))
            number = self._learn(fresh) + np.arange(len(some))
            at = np.searchsorted(self.hashes, some)
            self.hashes, self.word = np.insert(self.hashes, at, some), np.insert(self.word, at, number)
            # A word of `odd` has a number but no place in the list, so that gaps are filled here.
            gap = pa.array([""] * (int(number[0]) - len(self.words)), pa.large_string())
            self.words = pa.concat_arrays([self.words, gap, fresh])
        number = self._known(h)[1]
        same = np.asarray(pc.equal(self.words.take(pa.array(number)), words), bool)
        for i in np.flatnonzero(~same).tolist():  # words that share their hash with another
            w = words[i].as_py()
            if w not in self.odd:
                self.odd[w] = self._append(ids := self._ids([w])[0], [len(ids)])
            number[i] = self.odd[w]
        return number

    def _known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int32)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return self.hashes[at] == h, self.word[at]

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other, each with end_id; first index of each text, len + 1)."""
        if not self.by_word:
            lists = [e.ids + ([] if end_id is None else [end_id]) for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([x for y in lists for x in y], np.int64), np.concatenate([[0], np.cumsum([len(y) for y in lists], dtype=np.int64)])
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        # "Stem." and "stem" share an entry: a run of . or , at the end of an ASCII word is a piece of its own.
        words = coded.dictionary
        stems = pc.utf8_rtrim(words, ".,")
        plain = np.asarray(pc.ascii_is_alnum(stems).to_numpy(zero_copy_only=False), bool)
        keys = pc.if_else(pa.array(plain), pc.ascii_lower(stems), words)
        tails = pc.if_else(pa.array(plain), _tails(words, stems), "")
        both = pa.chunked_array([keys, tails]).combine_chunks().dictionary_encode()
        at = self._numbers(both.dictionary.cast(pa.large_string()))
        code = both.indices.to_numpy(zero_copy_only=False)
        pair = np.stack([at[code[: len(words)]], at[code[len(words) :]]], 1)
        pieces = pair[coded.indices.to_numpy(zero_copy_only=False)].ravel()
        off = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        off = 2 * (off - off[0])
        if end_id is not None:
            # The end of a text is one more piece, put among the pieces, of which there are fewer than ids.
            pieces = np.insert(pieces, off[1:], self._end(end_id))
            off += np.arange(len(off))
        begin = self.start[pieces]
        lens = self.start[pieces + 1] - begin
        before = np.concatenate([[0], np.cumsum(lens)])
        begin -= before[:-1]
        kind = np.int32 if max(before[-1], len(self.pool)) < 1 << 31 else np.int64
        at = np.repeat(begin.astype(kind), lens)
        at += np.arange(before[-1], dtype=kind)
        return self.pool[at], before[off]

    def _end(self, end_id: int) -> int:
        """The number of a piece that is the end id only."""
        key = f"\n{end_id}"  # no word holds a line end
        if key not in self.odd:
            self.odd[key] = self._append([end_id], [1])
        return self.odd[key]


def _tails(words: pa.Array, stems: pa.Array) -> pa.Array:
    """What rtrim took away: mostly one character, so only longer ones are cut one by one."""
    n = np.asarray(pc.binary_length(words)) - np.asarray(pc.binary_length(stems))
    out = pc.if_else(pa.array(n > 0), pc.utf8_slice_codeunits(words, -1), "")
    longer = np.flatnonzero(n > 1)
    if not len(longer):
        return out
    cut = [w[-k:] for w, k in zip(words.take(pa.array(longer)).to_pylist(), n[longer].tolist())]
    return pc.replace_with_mask(out, pa.array(n > 1), pa.array(cut, out.type))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder of a vocabulary file (keyed by its path, so never another file's)."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
