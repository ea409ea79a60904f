"""Cuckoo filter over 64-bit keys, filled by whole arrays."""

from __future__ import annotations

import struct

import numpy as np

SLOTS = 4
_HEAD = "<4sQ"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may be in one of two buckets.

    No false negatives; about 8 / 65536 false positives. Keys are unsigned
    64-bit hashes and must be distinct among those inserted.
    """

    def __init__(self, buckets: int):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.table = np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(4, int(np.ceil(np.log2(max(1, keys) / SLOTS / 0.85)))))

    def _where(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = _mix(keys.astype(np.uint64))
        mark = (mixed >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        return (mixed & np.uint64(len(self.table) - 1)).astype(np.int64), mark

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        step = (_mix(mark.astype(np.uint64)) | np.uint64(1)).astype(np.uint64)
        return (bucket.astype(np.uint64) ^ (step & np.uint64(len(self.table) - 1))).astype(np.int64)

    def insert(self, keys: np.ndarray) -> bool:
        """Insert all keys; False if the filter is too full (it is then unusable)."""
        bucket, mark = self._where(keys)
        chance = np.random.default_rng(len(keys))
        bucket, mark = self._settle(bucket, mark)
        bucket = self._other(bucket, mark)
        for _ in range(500):
            bucket, mark = self._settle(bucket, mark)
            if not len(bucket):
                return True
            # One key per bucket pushes out a random inhabitant, which moves on.
            bucket, first = np.unique(bucket, return_index=True)
            waiting = np.ones(len(mark), bool)
            waiting[first] = False
            slot = chance.integers(0, SLOTS, len(bucket))
            out = self.table[bucket, slot].copy()
            self.table[bucket, slot] = mark[first]
            held_bucket, held_mark = self._pending[0][waiting], self._pending[1][waiting]
            bucket = np.concatenate([self._other(bucket, out), held_bucket])
            mark = np.concatenate([out, held_mark])
        return False

    def _settle(self, bucket: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put fingerprints into free slots of their buckets; return those without one."""
        order = np.argsort(bucket, kind="stable")
        bucket, mark = bucket[order], mark[order]
        start = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1]) if len(bucket) else np.zeros(0, np.int64)
        nth = np.arange(len(bucket)) - np.repeat(start, np.diff(np.concatenate([start, [len(bucket)]])))
        empty = self.table[bucket] == 0
        seen = np.cumsum(empty, axis=1)
        hit = empty & (seen == (nth + 1)[:, None])
        fits = hit.any(axis=1)
        self.table[bucket[fits], hit[fits].argmax(axis=1)] = mark[fits]
        self._pending = bucket[~fits], mark[~fits]
        return self._pending

    def contains(self, keys: np.ndarray) -> np.ndarray:
        bucket, mark = self._where(keys)
        here = (self.table[bucket] == mark[:, None]).any(axis=1)
        return here | (self.table[self._other(bucket, mark)] == mark[:, None]).any(axis=1)

    def delete(self, keys: np.ndarray) -> None:
        """Remove one fingerprint of each key; only keys that were inserted may be given."""
        for bucket, mark in zip(*self._where(keys)):
            for place in (bucket, self._other(np.array([bucket]), np.array([mark]))[0]):
                at = np.flatnonzero(self.table[place] == mark)
                if len(at):
                    self.table[place, at[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return struct.pack(_HEAD, b"CKF1", len(self.table)) + self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, content: bytes) -> CuckooFilter:
        magic, buckets = struct.unpack_from(_HEAD, content)
        if magic != b"CKF1":
            raise ValueError("not a cuckoo filter")
        made = cls(buckets)
        made.table = np.frombuffer(content, "<u2", offset=struct.calcsize(_HEAD)).reshape(buckets, SLOTS).astype(np.uint16)
        return made
