"""Token ids of whole texts with a public word-end BPE vocabulary.

The tokenizer's pieces never cross white space and nothing before it looks across it, so
a text's ids are those of its blank-separated words one after the other, and a full stop
or comma behind an ASCII letter at a word's end is a piece of its own. Each word is encoded
once and remembered in the worker; what is remembered is bounded by ``REMEMBER`` words and
changes no result.
"""

from __future__ import annotations

import os

import numpy as np

from millrace.llm.text import BLANK, LOWER, ragged, words

REMEMBER = 3_000_000
# New words are encoded in lines of so many, with a mark that is a token of its own between.
LINE = 200
MARK = "\x01"
_encoders: dict[str, WordEncoder] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.int32)
        self.used = 0

    def _encode_words(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, ids of all words)."""
        if any(MARK in w for w in new):
            ids = [e.ids for e in self.tokenizer.encode_batch(new, add_special_tokens=False)]
            return (np.fromiter(map(len, ids), np.int64, len(ids)),
                    np.fromiter((i for x in ids for i in x), np.int32))
        lines = [f" {MARK} ".join(new[k:k + LINE]) + f" {MARK}" for k in range(0, len(new), LINE)]
        every = np.concatenate([np.array(e.ids, np.int32) for e in
                                self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
        marks = np.flatnonzero(every == self.mark)
        return np.diff(marks, prepend=-1) - 1, every[every != self.mark]

    def _learn(self, data: np.ndarray, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        raw = data.tobytes()
        new = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start.tolist(), end.tolist())]
        count, fresh = self._encode_words(new)
        if self.used + len(fresh) > len(self.pool):
            self.pool = np.concatenate([self.pool[:self.used], fresh,
                                        np.zeros(self.used + len(fresh), np.int32)])
        else:
            self.pool[self.used:self.used + len(fresh)] = fresh
        begin = self.used + np.cumsum(count, dtype=np.int64) - count
        self.used += len(fresh)
        at = np.searchsorted(self.key, code)
        self.key = np.insert(self.key, at, code)
        self.start = np.insert(self.start, at, begin)
        self.count = np.insert(self.count, at, count)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets by row)."""
        # Special tokens are recognised in the text as it stands, so case must stay then.
        special = len(data) > 1 and bool(((data[:-1] == 60) & (data[1:] == 124)).any())
        found = words(data, offsets, lower=not special, cuts=_stops(data))
        code, index, place = np.unique(found.hash, return_index=True, return_inverse=True)
        if len(self.key) + len(code) > REMEMBER:
            self.forget()
        at = np.searchsorted(self.key, code)
        known = np.zeros(len(code), bool)
        near = at < len(self.key)
        known[near] = self.key[at[near]] == code[near]
        if not known.all():
            new = ~known
            self._learn(data, code[new], found.start[index[new]], found.end[index[new]])
            at = np.searchsorted(self.key, code)
        count = self.count[at].astype(np.int64)[place]
        ids = self.pool[ragged(self.start[at][place], count)]
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, total[found.first]

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.diff(self.encode(data, offsets)[1])


def _stops(data: np.ndarray) -> np.ndarray:
    """Positions of full stops and commas between an ASCII letter and a blank."""
    at = np.flatnonzero((data == 46) | (data == 44))
    at = at[(at > 0) & (at < len(data) - 1)]
    before = LOWER[data[at - 1]]
    return at[(before >= 97) & (before <= 122) & BLANK[data[at + 1]]]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
