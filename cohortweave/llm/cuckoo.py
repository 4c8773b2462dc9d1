"""A cuckoo filter over 64-bit hashes, held in one numpy array."""

from __future__ import annotations

import numpy as np

from cohortweave.llm.common import mix

SLOTS = 4
LOAD = 0.85
MAX_MOVES = 200


class CuckooFilter:
    """Set membership with deletions: no false negatives, about 2**-29 false positives.

    An item's 32-bit fingerprint sits in one of two buckets; either bucket follows from the
    other and the fingerprint. Insertion works on whole arrays: every round places what finds
    a free slot, and each full bucket trades one resident for one newcomer. Repeated items
    are kept once per insertion, so that each can be deleted on its own.
    """

    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), np.uint32)

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        return cls(1 << max(2, int(np.ceil(np.log2(max(n, 1) / (SLOTS * LOAD))))))

    @classmethod
    def of_bytes(cls, data: bytes) -> CuckooFilter:
        made = cls(0)
        made.table = np.frombuffer(data, np.uint32).reshape(-1, SLOTS).copy()
        return made

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _parts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = mix(hashes.astype(np.uint64), 7)
        prints = (mixed >> np.uint64(32)).astype(np.uint32)
        prints[prints == 0] = 1
        return prints, (mixed & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(prints.astype(np.uint64), 11) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, first = self._parts(hashes)
        second = self._other(first, prints)
        return (self.table[first] == prints[:, None]).any(1) | (self.table[second] == prints[:, None]).any(1)

    def insert(self, hashes: np.ndarray) -> bool:
        """False if the table is too full; the caller then builds a larger one from its exact keys."""
        prints, bucket = self._parts(hashes)
        # an item takes its second bucket at once where the first is the fuller one
        second = self._other(bucket, prints)
        fill = (self.table != 0).sum(1)
        bucket = np.where(fill[second] < fill[bucket], second, bucket)
        for turn in range(MAX_MOVES):
            if not len(prints):
                return True
            order = np.argsort(bucket, kind="stable")
            prints, bucket = prints[order], bucket[order]
            starts = np.r_[True, bucket[1:] != bucket[:-1]]
            rank = np.arange(len(bucket)) - np.maximum.accumulate(np.where(starts, np.arange(len(bucket)), 0))
            vacant = self.table[bucket] == 0
            fits = rank < vacant.sum(1)
            # the rank-th free slot of the bucket
            slot = (np.cumsum(vacant, 1) == (rank + 1)[:, None]).argmax(1)
            self.table[bucket[fits], slot[fits]] = prints[fits]
            prints, bucket = prints[~fits], bucket[~fits]
            if not len(prints):
                return True
            lead = np.r_[True, bucket[1:] != bucket[:-1]]
            where = bucket[lead]
            seat = (mix(prints[lead].astype(np.uint64), turn) % np.uint64(SLOTS)).astype(np.int64)
            evicted = self.table[where, seat].copy()
            self.table[where, seat] = prints[lead]
            prints = np.r_[evicted, prints[~lead]]
            bucket = np.r_[where, bucket[~lead]]
            bucket = self._other(bucket, prints)
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Takes one copy of each item out; the items must have been inserted."""
        prints, first = self._parts(hashes)
        for one, b in zip(prints, first, strict=True):
            for bucket in (b, self._other(np.asarray([b]), np.asarray([one]))[0]):
                seats = np.flatnonzero(self.table[bucket] == one)
                if len(seats):
                    self.table[bucket, seats[0]] = 0
                    break

    @classmethod
    def build(cls, hashes: np.ndarray, least: int = 0) -> CuckooFilter:
        size = max(len(hashes), least)
        while True:
            made = cls.sized(size)
            if made.insert(hashes):
                return made
            size *= 2
