"""Minimal perfect hashing of distinct 64-bit keys, in whole arrays.

Every level hashes the keys that are left into a bit array of `SPREAD` bits a key; a bit that exactly
one key hits belongs to that key, and the others go on to the next level.  A key's index is the
number of bits set before its own, over all levels, so n keys get the indexes 0 to n - 1.  What
is stored is about three bits a key; the keys themselves are kept in index order to tell a
key that was never there.
"""

from __future__ import annotations

import numpy as np

from heliovane.llm.common import mix

SPREAD = 1.5
#: A level's bits and the bits before each of its 64-bit words.
Level = tuple[int, np.ndarray, np.ndarray]


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)


def position(levels: list[Level], keys: np.ndarray) -> np.ndarray:
    """The index of every key of the hashed set; any value for others."""
    index, open_ = np.zeros(len(keys), np.int64), np.arange(len(keys))
    for number, (size, words, ranks) in enumerate(levels):
        if not len(open_):
            break
        places = _places(keys[open_], number, size)
        word, bit = words[places >> 6], (places & 63).astype(np.uint64)
        hit = (word >> bit & np.uint64(1)).astype(bool)
        below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
        index[open_[hit]] = ranks[places[hit] >> 6] + below
        open_ = open_[~hit]
    return index


class PerfectHash:
    """Levels for a set of distinct keys, and the keys in the order of their indexes."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[Level] = []
        left, before = keys.astype(np.int64), 0
        while len(left):
            size = -(-int(len(left) * SPREAD + 64) // 64) * 64
            places = _places(left, len(self.levels), size)
            alone = np.bincount(places, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view(np.uint64)
            ranks = before + np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((size, words, ranks[:-1]))
            left, before = left[~alone[places]], int(ranks[-1])
        self.keys = np.zeros(len(keys), np.int64)
        self.keys[position(self.levels, keys)] = keys


class ShardedHash:
    """One index over shards of keys that were hashed apart, the indexes of a shard after those of the one before."""

    def __init__(self, shards: list[PerfectHash]):
        self.starts = np.concatenate([[0], np.cumsum([len(s.keys) for s in shards])]).astype(np.int64)
        self.keys = np.concatenate([np.zeros(0, np.int64), *[s.keys for s in shards]])
        self.levels = [s.levels for s in shards]

    @staticmethod
    def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(32)) % np.uint64(shards)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Verified indexes, -1 for a key of no shard."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        index = np.zeros(len(keys), np.int64)
        shard = self.shard_of(keys, len(self.levels))
        for i, levels in enumerate(self.levels):
            mine = np.flatnonzero(shard == i) if len(self.levels) > 1 else slice(None)
            index[mine] = self.starts[i] + position(levels, keys[mine])
        index = np.minimum(index, len(self.keys) - 1)
        return np.where(self.keys[index] == keys, index, -1)
