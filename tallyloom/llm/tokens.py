"""Token ids of whole texts from a public tokenizer, with a per-worker cache of word ids.

The tokenizer lower-cases, drops white space and splits words at fixed character classes, so the
ids of a text are the ids of its words in a row. Words are cut at ASCII white space; a word of
ASCII and Latin-1 letters without an apostrophe is also cut where letters, digits and other
characters meet, as the tokenizer itself does. Only words not met before are encoded.
"""

from __future__ import annotations

import os

import numpy as np

from tallyloom.llm.textblock import WORDS, Block

#: Words a worker remembers at most; later ones are encoded each time they occur in a block.
CACHE = 1_000_000
_KIND = np.ones(256, np.uint8)
_KIND[[32, *range(9, 14)]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 2
_KIND[48:58] = 3


def _cuts(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the pieces whose ids do not depend on one another."""
    u = block.u
    if not len(u):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    latin = u == 0xC3
    after = np.zeros(len(u), bool)
    after[1:] = latin[:-1]
    odd = ((u >= 0x80) & ~latin & ~(after & (u != 0x97) & (u != 0xB7))) | (u == 0x27)
    kind = _KIND[u]
    turn = block.edges()
    space = WORDS[u] == 0
    turn[1:-1] |= kind[1:] != kind[:-1]
    if odd.any():  # such words stay whole
        words = block.tokens()
        total = np.zeros(len(u) + 1, np.int64)
        np.cumsum(odd, out=total[1:])
        for s, e in zip(*(x[total[words.end] > total[words.start]] for x in (words.start, words.end)), strict=True):
            turn[s + 1 : e] = False
    return np.flatnonzero(turn[:-1] & ~space), np.flatnonzero(turn[1:] & ~space) + 1


class WordTokens:
    """Ids of the texts of blocks; one instance per worker and tokenizer file."""

    _made: dict[str, WordTokens] = {}

    @classmethod
    def of(cls, path: str) -> WordTokens:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of known words
        self.at = np.zeros(0, np.int64)  # where a word's ids begin in flat
        self.n = np.zeros(0, np.int32)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        n = np.fromiter(map(len, ids), np.int32, len(ids))
        return np.fromiter((x for y in ids for x in y), np.uint32, int(n.sum())), n

    def __call__(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (one more than texts)."""
        start, end = _cuts(block)
        h = block.hashes(start, end, lower=True)
        uniq, first, back = np.unique(h, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, uniq)
        known = np.zeros(len(uniq), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == uniq[inside]
        at, n = np.zeros(len(uniq), np.int64), np.zeros(len(uniq), np.int64)
        at[known], n[known] = self.at[place[known]], self.n[place[known]]
        flat = self.flat
        if not known.all():
            new = ~known
            data, f = block.u.tobytes(), first[new]
            ids, count = self._encode([data[s:e].decode("utf-8", "replace") for s, e in zip(start[f].tolist(), end[f].tolist(), strict=True)])
            where = self.used + np.concatenate([[0], np.cumsum(count[:-1])]).astype(np.int64) if len(count) else np.zeros(0, np.int64)
            need = self.used + len(ids)
            if need > len(flat):
                flat = np.resize(flat, max(need, 2 * len(flat)))
            flat[self.used : need] = ids
            at[new], n[new] = where, count
            self.flat = flat
            if len(self.keys) < CACHE:  # else the ids written past `used` are overwritten next time
                self.at, self.n = np.insert(self.at, place[new], where), np.insert(self.n, place[new], count)
                self.keys = np.insert(self.keys, place[new], uniq[new])
                self.used = need
        per = n[back]
        stop = np.cumsum(per)
        total = int(stop[-1]) if len(stop) else 0
        take = np.arange(total) + np.repeat(at[back] - (stop - per), per)
        upto = np.concatenate([[0], stop])
        return flat[take], upto[np.searchsorted(start, block.off)]
