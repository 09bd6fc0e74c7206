"""Elias-Fano sequences over numpy words: monotone numbers in about 2 + log2(U / n) bits each.

A number's high part is written in unary (one set bit a number, one clear bit a
step of the high part), its low part in a fixed number of bits. All look-ups
take arrays and are vectorised. The arrays can lie in a memory-mapped file.
"""

from __future__ import annotations

import numpy as np

BLOCK = 8  # words between two sampled counts
ONE = np.uint64(1)


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits``-bit numbers, one after another, in 64-bit words."""
    words = np.zeros(len(values) * bits // 64 + 2, np.uint64)
    if bits and len(values):
        at = np.arange(len(values), dtype=np.int64) * bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(words, word, values << shift)
        over = np.flatnonzero(shift + np.uint64(bits) > 64)
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def _unpack(words: np.ndarray, bits: int, i: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(i), np.uint64)
    at = i.astype(np.int64) * bits
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    out = words[word] >> shift
    over = shift + np.uint64(bits) > 64
    out[over] |= words[word[over] + 1] << (np.uint64(64) - shift[over])
    return out & ((ONE << np.uint64(bits)) - ONE)


class EliasFano:
    """``values``: sorted unsigned 64-bit numbers, repeats allowed."""

    def __init__(self, values: np.ndarray, keep=lambda x: x):
        values = np.asarray(values, np.uint64)
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.bits = min(63, max(0, ((top + 1) // max(self.n, 1)).bit_length() - 1))
        low = values & np.uint64((1 << self.bits) - 1)
        high = (values >> np.uint64(self.bits)).astype(np.int64)
        self.low = keep(_pack(low, self.bits))
        length = (int(high[-1]) if self.n else 0) + self.n + 1
        words = -(-length // (64 * BLOCK)) * BLOCK
        flags = np.zeros(words * 64, np.uint8)
        flags[high + np.arange(self.n)] = 1
        self.high = keep(np.packbits(flags, bitorder="little").view(np.uint64))
        ones = np.bitwise_count(self.high).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
        self.ones = keep(np.concatenate([[0], np.cumsum(ones)]))
        self.zeros = keep(np.arange(len(self.ones)) * 64 * BLOCK - self.ones)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """The place of set (or clear) bit number ``k``."""
        counts = self.ones if one else self.zeros
        block = np.searchsorted(counts, k, side="right") - 1
        block = np.minimum(block, len(counts) - 2)
        rest = k - counts[block]
        word = block * BLOCK
        for _ in range(BLOCK - 1):
            here = np.bitwise_count(self.high[word]).astype(np.int64)
            if not one:
                here = 64 - here
            go = rest >= here
            if not go.any():
                break
            rest = rest - here * go
            word = word + go
        bits = self.high[word] if one else ~self.high[word]
        place = word * 64
        for s in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(bits & np.uint64((1 << s) - 1)).astype(np.int64)
            go = rest >= here
            rest = rest - here * go
            bits = np.where(go, bits >> np.uint64(s), bits)
            place = place + s * go
        return place

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.bits)) | _unpack(self.low, self.bits, i)

    def successor(self, x: np.ndarray, low: np.ndarray | None = None,
                  high: np.ndarray | None = None) -> np.ndarray:
        """The first place at or after ``low`` and before ``high`` with a value of at least ``x``.

        The unary part gives the run of places with the same high part; a binary
        search over low parts finds the place within it.
        """
        x = np.asarray(x, np.uint64)
        part = (x >> np.uint64(self.bits)).astype(np.int64)
        rest = x & np.uint64((1 << self.bits) - 1)
        beyond = part >= int(self.zeros[-1])
        safe = np.where(beyond, 0, part)
        end = np.where(beyond, self.n, self._select(safe, False) - safe)
        begin = np.where(part > 0, self._select(np.maximum(safe - 1, 0), False)
                         - np.maximum(safe - 1, 0), 0)
        begin = np.where(beyond, self.n, begin)
        end, begin = np.minimum(end, self.n), np.minimum(begin, self.n)
        if low is not None:
            begin, end = np.clip(begin, low, high), np.clip(end, low, high)
        while True:
            open_ = begin < end
            if not open_.any():
                return begin
            mid = (begin + end) >> 1
            less = open_ & (_unpack(self.low, self.bits, np.minimum(mid, max(self.n - 1, 0))) < rest)
            begin = np.where(less, mid + 1, begin)
            end = np.where(open_ & ~less, mid, end)

    def find(self, x: np.ndarray, low: np.ndarray | None = None,
             high: np.ndarray | None = None) -> np.ndarray:
        """The place of ``x`` (between ``low`` and ``high``), or -1."""
        if not self.n:
            return np.full(len(x), -1)
        at = self.successor(x, low, high)
        inside = at < (self.n if high is None else high)
        hit = inside & (self[np.minimum(at, self.n - 1)] == np.asarray(x, np.uint64))
        return np.where(hit, at, -1)
