"""A cuckoo filter over 64-bit hashes: a set that says no for certain, and forgets what is deleted."""

from __future__ import annotations

import random

import numpy as np

SLOTS = 4
#: Share of the slots that may be filled before the filter is made larger, and moves tried for an insertion.
LOAD = 0.9
MOVES = 500


class CuckooFilter:
    """Each hash has a 16-bit mark and two buckets, either of which follows from the other and the mark."""

    def __init__(self, buckets: int) -> None:
        self.marks = np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * LOAD < n:
            buckets *= 2
        return cls(buckets)

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        """A filter of the given hashes, as large as it takes."""
        out = cls.for_keys(len(hashes))
        while not all(out.insert(h) for h in hashes.tolist()):
            out = cls(len(out.marks) * 2)
        return out

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        out = cls(0)
        out.marks = np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy()
        return out

    def to_bytes(self) -> bytes:
        return self.marks.tobytes()

    def _places(self, h: int) -> tuple[int, int, int]:
        h &= 0xFFFFFFFFFFFFFFFF
        mark = (h >> 48) or 1
        first = h & (len(self.marks) - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ mark * 0x5BD1E995) & (len(self.marks) - 1)

    def insert(self, h: int) -> bool:
        """False if no room was found: the filter has then lost a mark and must be built anew."""
        mark, bucket, other = self._places(h)
        rng = random.Random(h)
        for b in (bucket, other):
            for s in range(SLOTS):
                if not self.marks[b, s]:
                    self.marks[b, s] = mark
                    return True
        for _ in range(MOVES):
            s = rng.randrange(SLOTS)
            mark, self.marks[bucket, s] = int(self.marks[bucket, s]), mark
            bucket = self._other(bucket, mark)
            for s in range(SLOTS):
                if not self.marks[bucket, s]:
                    self.marks[bucket, s] = mark
                    return True
        return False

    def delete(self, h: int) -> bool:
        """Takes one insertion of a hash back; only for hashes that were inserted."""
        mark, *buckets = self._places(h)
        for b in buckets:
            for s in range(SLOTS):
                if self.marks[b, s] == mark:
                    self.marks[b, s] = 0
                    return True
        return False

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may be in the set; never False for one that is."""
        mark, first, other = _both_buckets(hashes, np.uint64(len(self.marks) - 1))
        m = mark.astype(np.uint16)[:, None]
        return (self.marks[first] == m).any(axis=1) | (self.marks[other] == m).any(axis=1)


class CuckooShards:
    """The filters of all shards side by side, asked for many hashes at once. A shard without a filter knows nothing."""

    def __init__(self, n_shards: int, marks: dict[int, bytes]) -> None:
        self.n_shards = n_shards
        own = [np.frombuffer(marks[k], np.uint16).reshape(-1, SLOTS) if k in marks else np.zeros((1, SLOTS), np.uint16) for k in range(n_shards)]
        buckets = np.array([len(m) for m in own])
        self.masks = (buckets - 1).astype(np.uint64)
        self.begin = np.cumsum(buckets) - buckets
        self.marks = np.concatenate(own)

    def contains(self, shard_by: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may be in the filter of its shard, which is ``shard_by`` modulo the shards."""
        shard = shard_by % self.n_shards
        mark, first, other = _both_buckets(hashes, self.masks[shard])
        at = self.begin[shard]
        m = mark.astype(np.uint16)[:, None]
        return (self.marks[at + first] == m).any(axis=1) | (self.marks[at + other] == m).any(axis=1)


def _both_buckets(hashes: np.ndarray, mask: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = hashes.astype(np.int64).view(np.uint64)
    mark = np.maximum(h >> np.uint64(48), np.uint64(1))
    first = h & mask
    other = (first ^ mark * np.uint64(0x5BD1E995)) & mask
    return mark, first.astype(np.int64), other.astype(np.int64)
