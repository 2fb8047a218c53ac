"""A cuckoo filter over 128-bit keys, with inserts and deletes done for whole arrays."""

from __future__ import annotations

import numpy as np

from graphloom.llm.words import mixed

_SLOTS = 4


class CuckooFilter:
    """Buckets of four fingerprints of 32 bits; a key's lies in one of two buckets.

    Keys are given as rows of two 64-bit words. A key that is in is always found; one that
    is not is found with a chance of about 8 in 2^32. Only keys that are in may be deleted,
    which the exact table behind the filter has to see to.
    """

    def __init__(self, buckets: int):
        size = 1
        while size < buckets:
            size *= 2
        self.table = np.zeros((size, _SLOTS), np.uint32)

    @classmethod
    def of(cls, keys: np.ndarray, spare: float = 1.5) -> CuckooFilter:
        """A filter with room for ``spare`` times the keys."""
        made = cls(max(1, int(len(keys) * spare / _SLOTS) + 1))
        while not made.insert(keys):
            made = cls(2 * len(made.table))
        return made

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fingerprint = (keys[:, 1] >> np.uint64(32)).astype(np.uint32)
        fingerprint[fingerprint == 0] = 1
        bucket = (mixed(keys[:, 0]) & np.uint64(len(self.table) - 1)).astype(np.int64)
        return fingerprint, bucket

    def _other(self, fingerprint: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        step = (mixed(fingerprint.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)
        return bucket ^ step

    def insert(self, keys: np.ndarray, rounds: int = 500) -> bool:
        """Put all keys in; False, with the filter as it was, if that takes more moves than ``rounds``."""
        before = self.table.copy()
        fingerprint, bucket = self._places(keys)
        turn = 0
        while len(bucket):
            for slot in range(_SLOTS):
                # Of those that want the same free slot the first gets it.
                free = np.flatnonzero(self.table[bucket, slot] == 0)
                _, first = np.unique(bucket[free], return_index=True)
                placed = free[first]
                self.table[bucket[placed], slot] = fingerprint[placed]
                rest = np.ones(len(bucket), bool)
                rest[placed] = False
                fingerprint, bucket = fingerprint[rest], bucket[rest]
            if turn == rounds:
                self.table = before
                return False
            if turn == 0:
                bucket = self._other(fingerprint, bucket)
            elif len(bucket):
                # One per bucket throws out what lies in a slot, which moves to its other bucket.
                _, first = np.unique(bucket, return_index=True)
                slot = turn % _SLOTS
                out = self.table[bucket[first], slot].copy()
                self.table[bucket[first], slot] = fingerprint[first]
                moved = self._other(out, bucket[first])
                rest = np.ones(len(bucket), bool)
                rest[first] = False
                fingerprint = np.concatenate([out, fingerprint[rest]])
                bucket = np.concatenate([moved, bucket[rest]])
            turn += 1
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Take out one fingerprint for each key."""
        fingerprint, bucket = self._places(keys)
        other = self._other(fingerprint, bucket)
        pending = np.arange(len(fingerprint))
        for side in (bucket, other):
            for slot in range(_SLOTS):
                same = pending[self.table[side[pending], slot] == fingerprint[pending]]
                _, first = np.unique(side[same], return_index=True)
                gone = same[first]
                self.table[side[gone], slot] = 0
                pending = np.setdiff1d(pending, gone, assume_unique=True)

    def __contains__(self, key: tuple[int, int]) -> bool:
        return bool(self.found(np.array([key], np.uint64))[0])

    def found(self, keys: np.ndarray) -> np.ndarray:
        fingerprint, bucket = self._places(keys)
        here = (self.table[bucket] == fingerprint[:, None]).any(axis=1)
        return here | (self.table[self._other(fingerprint, bucket)] == fingerprint[:, None]).any(axis=1)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        made = cls(1)
        made.table = np.frombuffer(data, np.uint32).reshape(-1, _SLOTS).copy()
        return made
