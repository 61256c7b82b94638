"""Hashes of the pieces of an array of bytes, a table of numbers by hash, and where the public vocabularies lie."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceHash:
    """64-bit polynomial hashes of consecutive pieces, whatever their lengths, in a few passes over the bytes."""

    def __init__(self):
        self.inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The hash of each piece; ``at``: where they begin, the last one goes to the end."""
        if len(self.powers) < len(data):
            n = 1 << len(data).bit_length()
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE)])
            self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, self.inverse)])
        sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:len(data)], dtype=np.uint64)]
        x = (sums[np.r_[at[1:], len(data)]] - sums[at]) * self.inverses[at]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ x >> np.uint64(32)


class PieceTable:
    """Numbers from 0 by 64-bit hash, looked up many at a time (open addressing)."""

    def __init__(self, slots: int = 1 << 16):
        self.hashes, self.numbers, self.used = np.zeros(slots, np.uint64), np.zeros(slots, np.int32), 0

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(65 - len(self.hashes).bit_length())).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for those that are not in the table."""
        hashes = np.maximum(hashes, np.uint64(1))            # 0 marks an empty slot
        out = np.full(len(hashes), -1, np.int32)
        left, slot = np.arange(len(hashes)), self._slots(hashes)
        while len(left):
            there = self.hashes[slot]
            hit = there == hashes[left]
            out[left[hit]] = self.numbers[slot[hit]]
            on = ~hit & (there != 0)
            left, slot = left[on], (slot[on] + 1) & (len(self.hashes) - 1)
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Gives new, different hashes the next numbers, in their order."""
        hashes = np.maximum(hashes, np.uint64(1))
        if 2 * (self.used + len(hashes)) > len(self.hashes):
            old, numbers = self.hashes, self.numbers
            full = old != 0
            size = len(old)
            while 2 * (self.used + len(hashes)) > size:
                size *= 2
            self.hashes, self.numbers = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._put(old[full], numbers[full])
        self._put(hashes, np.arange(self.used, self.used + len(hashes), dtype=np.int32))
        self.used += len(hashes)

    def _put(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        slot = self._slots(hashes)
        while len(hashes):
            free = self.hashes[slot] == 0
            self.hashes[slot[free]] = hashes[free]           # of several for one slot, one stays
            placed = self.hashes[slot] == hashes
            self.numbers[slot[placed]] = numbers[placed]
            hashes, numbers, slot = hashes[~placed], numbers[~placed], (slot[~placed] + 1) & (len(self.hashes) - 1)
