"""Ids of short byte strings, remembered in a table of fixed size and looked up a batch at once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

SHORT = 16  # bytes of a key: two machine words
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_SHIFT = np.uint64(29)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h ^ word) * _M1
    return (h ^ (h >> _SHIFT)) * _M2


def hashed(low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(size * _M3, low), high)


def word_view(data: bytes) -> np.ndarray:
    """The machine word that begins at every byte of ``data`` (zeros behind the last byte)."""
    padded = np.frombuffer(data + bytes(24), np.uint8)
    return np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(padded) - 7,), (1,))


def key(words: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First 16 bytes as two words, and the length."""
    low = words[at] & _MASKS[np.minimum(size, 8)]
    high = words[at + 8] & _MASKS[np.clip(size - 8, 0, 8)]
    return low, high, size.astype(np.uint64)


class IdTable:
    """A direct-mapped table: a string has one place, and the newest string there is remembered.

    Strings of at most 16 bytes are compared as a whole, so what is found is exact; what is not
    found is computed again.
    """

    def __init__(self, bits: int = 20, ids: int = 1 << 23):
        self.shift = np.uint64(64 - bits)
        self.low, self.high = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.size, self.many = np.zeros(1 << bits, np.uint8), np.zeros(1 << bits, np.uint8)
        self.at = np.zeros(1 << bits, np.int32)
        self.ids = np.zeros(ids, np.uint32)
        self.used = 0

    def look_up(
        self, words: np.ndarray, at: np.ndarray, size: np.ndarray, compute: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids, string after string, and how many each string has.

        ``compute(at, size)`` gives the same for the distinct strings that are not in the table.
        """
        room = int(size.sum())  # no string has more ids than bytes
        if self.used + room > len(self.ids):
            self.size[:], self.used = 0, 0
            if room > len(self.ids):
                self.ids = np.zeros(room, np.uint32)
        low, high, length = key(words, at, size)
        h = hashed(low, high, length)
        slot = (h >> self.shift).astype(np.int64)
        hit = (self.low[slot] == low) & (self.high[slot] == high) & (self.size[slot] == size)
        place, many = self.at[slot].astype(np.int64), self.many[slot].astype(np.int64)
        miss = np.flatnonzero(~hit)
        if len(miss):
            miss = miss[np.argsort(h[miss], kind="stable")]
            new = np.ones(len(miss), bool)
            new[1:] = False
            for x in (low, high, length):
                new[1:] |= x[miss[1:]] != x[miss[:-1]]
            first, group = miss[new], np.cumsum(new) - 1
            ids, counts = compute(at[first], size[first])
            begin = self.used + np.cumsum(counts) - counts
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            where, one = np.unique(slot[first], return_index=True)
            keep = first[one]
            self.low[where], self.high[where], self.size[where] = low[keep], high[keep], size[keep]
            self.at[where], self.many[where] = begin[one], counts[one]
            place[miss], many[miss] = begin[group], counts[group]
        shift = place - (np.cumsum(many) - many)
        return self.ids[np.repeat(shift, many) + np.arange(int(many.sum()))], many
