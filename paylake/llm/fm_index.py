"""FM-index over integer sequences, as numpy arrays: suffix array by prefix
doubling, Burrows-Wheeler transform in a wavelet matrix, backward search of
many phrases at once, and location through sampled suffix positions."""

from __future__ import annotations

import numpy as np

# Every so many-th position of a run has its suffix position stored.
SAMPLE = 8


class _Bits:
    """A bit vector with constant-time rank: a count before every 64 bits."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    """rank(symbol, i) and access(i) over symbols below 2 ** depth."""

    def __init__(self, seq: np.ndarray, depth: int):
        self.levels: list[tuple[_Bits, int]] = []
        for level in range(depth - 1, -1, -1):
            bits = (seq >> level & 1).astype(np.uint8)
            self.levels.append((_Bits(bits), int(len(bits) - bits.sum())))
            seq = np.concatenate([seq[bits == 0], seq[bits == 1]])
        self.depth = depth

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        start = np.zeros_like(i)
        for k, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - k) & 1).astype(bool)
            a, b = bits.rank1(start), bits.rank1(i)
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
        return i - start

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its occurrences before it."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for bits, zeros in self.levels:
            one = bits.get(i).astype(bool)
            a, b = bits.rank1(start), bits.rank1(i)
            symbol = symbol * 2 + one
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
        return symbol, i - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes. Zeros are separators: each is smaller than every
    symbol and than all later separators, so comparisons end at the first one."""
    n = len(text)
    sep = text == 0
    rank = np.where(sep, np.cumsum(sep) - 1, text.astype(np.int64) + n)
    _, rank = np.unique(rank, return_inverse=True)
    order, k = np.argsort(rank, kind="stable"), 1
    while n and rank.max() < n - 1:
        ahead = np.zeros(n, np.int64)
        ahead[:n - k] = rank[k:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        k *= 2
    return order


class FMIndex:
    """Index of ``text``: symbols 1 .. n_symbols, runs ended by 0, the last one too."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        sa = suffix_array(text)
        bwt = text[sa - 1]  # the first position is preceded by the last, a separator
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        self.wavelet = WaveletMatrix(bwt.astype(np.int64), max(1, int(n_symbols).bit_length()))
        self.n = len(text)
        # sampled: every SAMPLE-th position, and each run's first, so that a
        # walk back never has to cross a separator
        stored = (sa % SAMPLE == 0) | (bwt == 0)
        self.stored = _Bits(stored.astype(np.uint8))
        self.positions = sa[stored]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half-open row ranges of the suffixes that start with each phrase
        (row-padded with zeros); symbols from last to first."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        for back in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (lo < hi))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - back]
            base = self.first[symbol]
            lo[live] = base + self.wavelet.rank(symbol, lo[live])
            hi[live] = base + self.wavelet.rank(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back until a sampled one."""
        out = np.empty(len(rows), np.int64)
        at, todo, steps = rows.copy(), np.arange(len(rows)), 0
        while len(todo):
            hit = self.stored.get(at).astype(bool)
            out[todo[hit]] = self.positions[self.stored.rank1(at[hit])] + steps
            at, todo = at[~hit], todo[~hit]
            symbol, rank = self.wavelet.access_rank(at)
            at = self.first[symbol] + rank
            steps += 1
        return out


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the half-open ranges, and which range each is from."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[which], which
