"""Elias-Fano coding of a non-decreasing sequence, with a select structure.

``n`` values up to ``u`` take about ``n * (2 + log2(u / n))`` bits: the low bits of each value are
packed side by side and the high parts become a bit vector in which the i-th one stands at
``high(i) + i``.  The place of every 64th one is kept, so ``select(i)`` looks at a few bytes only.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 64
_HEAD = struct.Struct("<QQB7x")


def _pad8(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def encode(values: np.ndarray) -> bytes:
    values = np.asarray(values, np.uint64)
    n, u = len(values), int(values[-1]) if len(values) else 0
    low = max(0, (u // n).bit_length() - 1) if n else 0
    head = _HEAD.pack(n, u, low)
    if not n:
        return head
    bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(places[-1]) + 1, np.uint8)
    high[places] = 1
    return (
        head
        + _pad8(np.packbits(bits.ravel(), bitorder="little").tobytes())
        + _pad8(places[::SAMPLE].astype("<u4").tobytes())
        + _pad8(np.packbits(high, bitorder="little").tobytes())
    )


class Reader:
    """Reads a coded sequence in place; ``size`` is the number of bytes it takes."""

    def __init__(self, data: memoryview):
        self.n, self.u, self.low = _HEAD.unpack_from(data, 0)
        at = _HEAD.size
        self.size = at
        if not self.n:
            return
        low_bytes = -(-self.n * self.low // 8)
        self.lows = np.frombuffer(data, np.uint8, low_bytes, at)
        at += -(-low_bytes // 8) * 8
        samples = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(data, "<u4", samples, at)
        at += -(-samples * 4 // 8) * 8
        high_bytes = -(-((self.u >> self.low) + self.n) // 8)
        self.highs = np.frombuffer(data, np.uint8, high_bytes, at)
        self.size = at + -(-high_bytes // 8) * 8

    def _low_of(self, i: int) -> int:
        first, end = i * self.low, (i + 1) * self.low
        part = int.from_bytes(self.lows[first // 8 : -(-end // 8)].tobytes(), "little")
        return part >> (first % 8) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sample on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = place // 8
        word = int(self.highs[byte]) >> (place % 8) << (place % 8)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.highs[byte])
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        return (place - i) << self.low | self._low_of(i)

    def all(self) -> np.ndarray:
        """Every value, as 64-bit numbers."""
        if not self.n:
            return np.empty(0, np.int64)
        places = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        bits = np.unpackbits(self.lows, bitorder="little")[: self.n * self.low].reshape(self.n, self.low)
        lows = (bits.astype(np.int64) << np.arange(self.low)).sum(axis=1) if self.low else 0
        return ((places - np.arange(self.n)) << self.low) + lows
