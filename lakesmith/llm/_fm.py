"""FM-index over the words of a bounded text shard (helper of the tasks).

Words are the symbols.  The suffix array comes from prefix doubling on packed
64-bit keys (only suffixes still tied are sorted again), the BWT is held in a
wavelet matrix with popcount ranks, and every ``SAMPLE``-th text position is
kept for ``locate``.  All searches run for many patterns at once.
"""

from __future__ import annotations

import numpy as np

BITS = 21
MASK = (1 << BITS) - 1
#: most symbols (words and text ends) of one index
LIMIT = MASK
SAMPLE = 16


def suffix_array(x: np.ndarray) -> np.ndarray:
    """Suffix array of ``x``, whose text ends are unique values (so no suffix ties with another)."""
    n = len(x)
    key = (x.astype(np.int64) << BITS) | np.arange(n)
    key.sort()
    sa = key & MASK
    rank = np.empty(n, np.int64)
    at = np.arange(n)

    def settle(key, at):
        """Ranks of the sorted keys; returns the places that are still tied."""
        same = np.zeros(len(key) + 1, bool)
        np.equal(key[1:] >> BITS, key[:-1] >> BITS, out=same[1:-1])
        rank[key & MASK] = np.maximum.accumulate(np.where(same[:-1], 0, at))
        return at[same[:-1] | same[1:]]

    at, h = settle(key, at), 1
    while len(at):
        i = sa[at]
        key = (rank[i] << (2 * BITS)) | (rank[np.minimum(i + h, n - 1)] << BITS) | i
        key.sort()
        sa[at] = key & MASK
        at = settle(key, at)
        h *= 2
    return sa


class Wavelet:
    """Wavelet matrix: rank and access of symbols in O(bits of a symbol)."""

    def __init__(self, x: np.ndarray, top: int):
        self.n, x = len(x), x.astype(np.int32)
        self.levels = []
        for b in range(max(1, int(top).bit_length()) - 1, -1, -1):
            one = (x & np.int32(1 << b)) != 0
            packed = np.packbits(one, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
            before = np.zeros(len(packed), np.int64)
            np.cumsum(np.bitwise_count(packed[:-1]), out=before[1:])
            x = np.concatenate([x[~one], x[one]])
            self.levels.append((b, packed, before, self.n - int(one.sum())))

    @staticmethod
    def _ones(packed, before, i):
        w = i >> 6
        return before[w] + np.bitwise_count(packed[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position ``i`` of each symbol's row lands on the lowest level."""
        for b, packed, before, zeros in self.levels:
            ones = self._ones(packed, before, i)
            i = np.where((symbol >> b) & 1, zeros + ones, i - ones)
        return i

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at ``i`` and its place on the lowest level."""
        symbol = np.zeros(len(i), np.int64)
        for b, packed, before, zeros in self.levels:
            bit = (packed[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0
            ones = self._ones(packed, before, i)
            symbol |= bit.astype(np.int64) << b
            i = np.where(bit, zeros + ones, i - ones)
        return symbol, i


class FMIndex:
    """Index over the texts ``hashes[first[k]:first[k + 1]]``; patterns are rows of word hashes.

    Words are told apart by the upper 43 bits of their hash; callers that need
    certainty compare the full hashes of what was located.
    """

    def __init__(self, hashes: np.ndarray, first: np.ndarray, locate: bool = True):
        texts, n = len(first) - 1, len(hashes) + len(first) - 1
        if n > LIMIT:
            raise ValueError(f"{n} symbols in one shard; at most {LIMIT}")
        lengths = np.diff(first)
        self.begin = first[:-1] + np.arange(texts)            # of each text, text ends included
        ends = self.begin + lengths
        where = np.arange(len(hashes)) + np.repeat(np.arange(texts), lengths)
        packed = (hashes & ~np.uint64(MASK)) | np.arange(len(hashes), dtype=np.uint64)
        packed.sort()
        word = packed >> np.uint64(BITS)
        new = np.ones(len(word), bool)
        new[1:] = word[1:] != word[:-1]
        self.vocabulary = word[new]
        x = np.empty(n, np.int64)
        x[ends] = np.arange(texts)                            # unique, below every word
        x[where[(packed & np.uint64(MASK)).astype(np.int64)]] = texts + np.cumsum(new) - 1
        self.sa = suffix_array(x)
        symbol = np.maximum(x - texts + 1, 0)                 # 0: any text end
        bwt = symbol[self.sa - 1]
        top = len(self.vocabulary)
        self.wavelet = Wavelet(bwt, top)
        self.before = np.zeros(top + 2, np.int64)
        np.cumsum(np.bincount(symbol, minlength=top + 1), out=self.before[1:])
        all_symbols = np.arange(top + 1)
        self.base = self.wavelet.place(all_symbols, np.zeros(top + 1, np.int64))
        self.n = n
        if locate:
            kept = (self.sa % SAMPLE == 0) | (bwt == 0)
            self.marked = np.concatenate([[0], np.cumsum(kept)])
            self.sampled = self.sa[kept]
            self.sa = None

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol of each word hash, -1 for words that the shard lacks."""
        word = hashes >> np.uint64(BITS)
        at = np.searchsorted(self.vocabulary, word)
        found = at < len(self.vocabulary)
        found[found] = self.vocabulary[at[found]] == word[found]
        return np.where(found, at + 1, -1)

    def step(self, symbol, lo, hi):
        """One backward step: rows that start with ``symbol`` and go on as the rows ``lo:hi``."""
        c = self.before[symbol] - self.base[symbol]
        return c + self.wavelet.place(symbol, lo), c + self.wavelet.place(symbol, hi)

    def search(self, patterns: np.ndarray, lengths: np.ndarray, least: int = 1):
        """Rows ``lo:hi`` of each pattern (symbols, right-aligned); empty once fewer than ``least`` remain."""
        k, width = patterns.shape
        lo, hi = np.zeros(k, np.int64), np.full(k, self.n, np.int64)
        live = np.arange(k)
        for j in range(width):
            go = live[lengths[live] > j]
            if not len(go):
                break
            c = patterns[go, width - 1 - j]
            known = c > 0
            lo[go[~known]] = hi[go[~known]] = 0
            go, c = go[known], c[known]
            lo[go], hi[go] = self.step(c, lo[go], hi[go])
            short = hi[go] - lo[go] < least
            lo[go[short]] = hi[go[short]] = 0
            live = go[~short]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position (text ends included) of each row, walking back to a sampled one."""
        out = np.full(len(rows), -1, np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            done = self.marked[at + 1] > self.marked[at]
            out[todo[done]] = self.sampled[self.marked[at[done]]] + steps
            todo, at = todo[~done], at[~done]
            if len(todo):
                symbol, place = self.wavelet.access(at)
                at = self.before[symbol] - self.base[symbol] + place
            steps += 1
        return out
