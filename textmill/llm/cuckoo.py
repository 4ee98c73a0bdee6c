"""A cuckoo filter over arrays of keys (Fan et al., 2014)."""

from __future__ import annotations

import numpy as np

SLOTS = 4
_ROUNDS = 200


class CuckooFilter:
    """Set of 16-bit fingerprints in buckets of four slots.

    A key is two 64-bit hashes: the first one gives its bucket, the second one its
    fingerprint. Answers "absent" are certain, answers "present" may be wrong for about one
    key in 8,000. Only keys that are in may be deleted. Insertion of an array either succeeds
    or returns False and leaves the filter unusable; the caller then builds a larger one.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.mask = np.uint64(buckets - 1)
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        """Empty, with a power of two of buckets that are at most 80 % full with n keys."""
        return cls(1 << max(4, int(np.ceil(np.log2(max(n, 1) / (0.8 * SLOTS))))))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(table), table)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        print_ = (h2.view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        print_ = np.where(print_ == 0, np.uint16(1), print_)
        first = h1.view(np.uint64) & self.mask
        return print_, first, self._other(first, print_)

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        return bucket ^ ((print_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) & self.mask)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        print_, first, second = self._places(h1, h2)
        wanted = print_[:, None]
        return (self.table[first] == wanted).any(axis=1) | (self.table[second] == wanted).any(axis=1)

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> bool:
        """Place all keys in rounds: each bucket takes what it has room for, one of the others evicts."""
        print_, bucket, other = self._places(h1, h2)
        room = lambda b: (self.table[b] == 0).sum(axis=1)
        bucket = np.where(room(bucket) > 0, bucket, other)
        for turn in range(_ROUNDS):
            if not len(print_):
                return True
            order = np.argsort(bucket, kind="stable")
            print_, bucket = print_[order], bucket[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            empty = np.argsort(self.table[bucket] != 0, axis=1, kind="stable")
            fits = rank < room(bucket)
            slot = np.take_along_axis(empty, np.minimum(rank, SLOTS - 1)[:, None], axis=1)[:, 0]
            self.table[bucket[fits], slot[fits]] = print_[fits]
            print_, bucket = print_[~fits], bucket[~fits]
            if not len(print_):
                return True
            _, evictors = np.unique(bucket, return_index=True)
            at, place = bucket[evictors], (turn + print_[evictors]) % SLOTS
            evicted = self.table[at, place].copy()
            self.table[at, place] = print_[evictors]
            print_[evictors] = evicted
            bucket[evictors] = self._other(at, evicted)
        return False

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        print_, first, second = self._places(h1, h2)
        while len(print_):
            both = np.concatenate([self.table[first], self.table[second]], axis=1) == print_[:, None]
            if not both.any(axis=1).all():
                raise KeyError("a key to delete is not in the filter")
            hit = both.argmax(axis=1)
            at = np.where(hit < SLOTS, first, second).astype(np.int64) * SLOTS + hit % SLOTS
            # Keys with the same fingerprint and buckets share copies of it: one is cleared at a time.
            cells, which = np.unique(at, return_index=True)
            self.table.reshape(-1)[cells] = 0
            rest = np.ones(len(print_), bool)
            rest[which] = False
            print_, first, second = print_[rest], first[rest], second[rest]
