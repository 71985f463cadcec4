"""A minimal perfect hash of 64-bit keys, in numpy: levels of collision-free bits.

On each level the remaining keys are hashed into a bit array; a place that just
one key takes becomes a one, the others' keys go on to the next level. The number
of a key is the number of ones before its place, over all levels; the few keys
left after the last level are numbered by their order.
"""

from __future__ import annotations

import struct

import numpy as np

#: Bits a key on a level, and levels before the rest is listed.
SPREAD, LEVELS = 2.0, 24
_HEAD = "<QQQ"


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A hash of 64-bit keys: the finishing steps of a split-mix generator."""
    z = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Numbers 0 ... n - 1 for the n distinct keys that it is built of."""

    def __init__(self, sizes: list[int], words: np.ndarray, rest: np.ndarray):
        self.sizes, self.words, self.rest = sizes, words, rest
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])
        self.n = int(self.before[-1]) + len(rest)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys."""
        left, sizes, words = keys.astype(np.uint64), [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(1, -(-int(SPREAD * len(left)) // 64)) * 64
            at = (mixed(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, dtype="<u8"), np.sort(left))

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; any number or -1 for a key that is none of the set (compare the stored key)."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, dtype=np.int64)
        todo, begin = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = (mixed(keys[todo], level) % np.uint64(size)).astype(np.int64) + begin
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (self.before[at >> 6] + np.bitwise_count(below))[hit]
            todo = todo[~hit]
            begin += size
            if not len(todo):
                return out
        if len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            hit = self.rest[at] == keys[todo]
            out[todo[hit]] = int(self.before[-1]) + at[hit]
        return out

    def to_bytes(self) -> bytes:
        return (struct.pack(_HEAD, len(self.sizes), len(self.words), len(self.rest)) + np.array(self.sizes, "<u8").tobytes()
                + self.words.astype("<u8").tobytes() + self.rest.astype("<u8").tobytes())

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        levels, words, rest = struct.unpack_from(_HEAD, data)
        rows = np.frombuffer(data, dtype="<u8", offset=struct.calcsize(_HEAD))
        return cls([int(x) for x in rows[:levels]], rows[levels:levels + words], rows[levels + words:levels + words + rest])
