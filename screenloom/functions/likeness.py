"""Likeness of titles in blocks: bounds for all pairs in arrays, the matching-blocks ratio for the pairs that are left."""

from __future__ import annotations

import difflib

import numpy as np

#: Letters of a title key (title_key_untagged): blank, digits, ASCII letters.
_CODE = np.full(256, 37, dtype=np.uint8)
_CODE[[ord(c) for c in " 0123456789abcdefghijklmnopqrstuvwxyz"]] = np.arange(37, dtype=np.uint8)
_LETTERS = 38
_WORD = 64
#: Buckets of letter pairs and triples; equal buckets of different ones only raise a bound.
_BUCKETS = 1 << 10
#: Pairs whose bounds are computed at once.
SLICE = 8_192


class Titles:
    """Title keys of a block, grouped by their length in machine words: codes for the text side, position bits for the pattern side."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        self.words = np.maximum(1, -(-self.length // _WORD))
        self.row = np.zeros(len(texts), dtype=np.int64)
        self._codes: dict[int, np.ndarray] = {}
        self._bits: dict[int, np.ndarray] = {}
        self.members = {int(w): np.nonzero(self.words == w)[0] for w in np.unique(self.words)}
        for own in self.members.values():
            self.row[own] = np.arange(len(own))

    def codes(self, w: int) -> np.ndarray:
        """(position, title) of the titles of w words; behind their end stands a letter that matches nothing."""
        if w not in self._codes:
            own = self.members[w]
            grid = np.full((len(own), w * _WORD), 37, dtype=np.uint8)
            for k, i in enumerate(own):
                grid[k, : self.length[i]] = _CODE[np.frombuffer(self.texts[i].encode("latin-1", "replace"), dtype=np.uint8)]
            self._codes[w] = np.ascontiguousarray(grid[:, : self.length[own].max(initial=1)].T)
        return self._codes[w]

    def bits(self, w: int) -> np.ndarray:
        """(word, title * letter): where each letter stands."""
        if w not in self._bits:
            own = self.members[w]
            table = np.zeros((w, len(own) * _LETTERS), dtype=np.uint64)
            for k, i in enumerate(own):
                codes = _CODE[np.frombuffer(self.texts[i].encode("latin-1", "replace"), dtype=np.uint8)].astype(np.int64)
                at = np.arange(len(codes))
                np.bitwise_or.at(table, (at // _WORD, k * _LETTERS + codes), np.uint64(1) << (at % _WORD).astype(np.uint64))
            table.reshape(w, len(own), _LETTERS)[:, :, 37] = 0
            self._bits[w] = table
        return self._bits[w]

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(title, bucket): 1 where a title has a run of ``size`` letters of the bucket; and how many runs of each title only repeat a bucket."""
        has = np.zeros((len(self.texts), _BUCKETS), dtype=np.float32)
        for k, text in enumerate(self.texts):
            codes = _CODE[np.frombuffer(text.encode("latin-1", "replace"), dtype=np.uint8)].astype(np.uint32)
            run = np.zeros(max(0, len(codes) - size + 1), dtype=np.uint32)
            for p in range(size):
                run = run * np.uint32(_LETTERS) + codes[p : p + len(run)]
            has[k, (run * np.uint32(2654435761)) >> np.uint32(22)] = 1
        return has, np.maximum(0, self.length - size + 1) - has.sum(axis=1)


def common(a: Titles, b: Titles, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each pair (a[i], b[j]), bit-parallel (Hyyro 2004). No matching blocks hold more letters."""
    out = np.zeros(len(i), dtype=np.int64)
    kind = a.words[i] * (1 << 32) + b.words[j]
    for k in np.unique(kind):
        wa, wb = int(k >> 32), int(k & 0xFFFFFFFF)
        bits, codes = a.bits(wa), b.codes(wb)
        at = np.nonzero(kind == k)[0]
        step = max(64, SLICE * 2 // (wa * max(1, wb // 2)))
        for s in range(0, len(at), step):
            own = at[s : s + step]
            x, letters = a.row[i[own]] * _LETTERS, codes[:, b.row[j[own]]]
            v = [np.full(len(own), ~np.uint64(0)) for _ in range(wa)]
            for c in letters:
                place = x + c
                carry = None
                for w in range(wa):
                    u = v[w] & bits[w].take(place)
                    up = v[w] + u
                    if wa > 1:
                        over = up < v[w]
                        if carry is not None:
                            up += carry
                            over |= up < carry
                        carry = over.astype(np.uint64)
                    v[w] = up | (v[w] & ~u)
            # zeros stand for matched letters; bits behind the pattern's end never become zero
            out[own] = sum(np.bitwise_count(~x).astype(np.int64) for x in v)
    return out


def shared_bound(a: Titles, b: Titles) -> np.ndarray:
    """(title of a, title of b): what the ratio can't exceed by the runs of two and of three letters that both have.

    M letters in k blocks hold M - k shared pairs of neighbours and M - 2k triples, and between two blocks stands a letter that isn't matched, of
    which there are m + n - 2M: k <= m + n - 2M + 1.
    """
    total = a.length[:, None] + b.length[None, :]
    bound = np.ones(total.shape)
    for size in (2, 3):
        (x, p), (y, q) = a.grams(size), b.grams(size)
        shared = x @ y.T + np.minimum(p[:, None], q[None, :])
        lost = size - 1
        bound = np.minimum(bound, 2 * (shared + lost * (total + 1)) / ((2 * lost + 1) * total))
    return bound


def exact_ratio(x: str, y: str) -> float:
    """Longest-matching-blocks ratio of two keys."""
    return difflib.SequenceMatcher(None, x, y).ratio()
