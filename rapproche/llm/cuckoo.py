"""Cuckoo filter over 128-bit keys: approximate membership with deletion, as NumPy operations on whole batches."""

from __future__ import annotations

import numpy as np

from rapproche.llm.words import mix

SLOTS = 4
LOAD = 0.85
ROUNDS = 200


class CuckooFilter:
    """Blocks of buckets with four 16-bit fingerprints. A full block is followed by another of twice its size.

    Keys come as two arrays of 64-bit halves and must be distinct: a key that is added twice has to be removed twice.
    """

    def __init__(self, blocks: list[bytes] | None = None):
        self.blocks = [np.frombuffer(b, np.uint16).reshape(-1, SLOTS).copy() for b in blocks or []]

    def to_bytes(self) -> list[bytes]:
        return [b.tobytes() for b in self.blocks]

    @staticmethod
    def _fingerprint(low: np.ndarray) -> np.ndarray:
        return (mix(low.astype(np.int64).view(np.uint64)) % np.uint64(0xFFFF) + np.uint64(1)).astype(np.uint16)

    @staticmethod
    def _first(high: np.ndarray, block: np.ndarray) -> np.ndarray:
        return (mix(high.astype(np.int64).view(np.uint64)) & np.uint64(len(block) - 1)).astype(np.int64)

    @staticmethod
    def _other(bucket: np.ndarray, print_: np.ndarray, block: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(print_.astype(np.uint64)) & np.uint64(len(block) - 1)).astype(np.int64)

    def contains(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        found = np.zeros(len(high), bool)
        mark = self._fingerprint(low)
        for block in self.blocks:
            first = self._first(high, block)
            for bucket in (first, self._other(first, mark, block)):
                found |= (block[bucket] == mark[:, None]).any(1)
        return found

    def add(self, high: np.ndarray, low: np.ndarray) -> None:
        mark = self._fingerprint(low)
        for block in self.blocks[-1:]:
            room = int(block.size * LOAD) - int(np.count_nonzero(block))
            here = max(0, min(room, len(high)))
            left = self._fill(block, high[:here], mark[:here])
            high, low, mark = (np.concatenate([a[:here][left], a[here:]]) for a in (high, low, mark))
        while len(high):
            size = max(len(self.blocks[-1]) * 2 if self.blocks else 16, int(len(high) / SLOTS / LOAD) + 1)
            block = np.zeros((1 << (size - 1).bit_length(), SLOTS), np.uint16)
            self.blocks.append(block)
            left = self._fill(block, high, mark)
            high, low, mark = high[left], low[left], mark[left]

    def _fill(self, block: np.ndarray, high: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Puts fingerprints in ``block``, moving others to their second bucket; index of the keys left over.

        A fingerprint that is moved out and finds no place is put back by undoing the whole batch.
        """
        before = block.copy()
        owner = np.arange(len(high))  # -1: a fingerprint that was in the block
        bucket, pending = self._first(high, block), mark.copy()
        for turn in range(ROUNDS):
            for _ in range(2):
                placed = self._place(block, bucket, pending)
                bucket, pending, owner = bucket[~placed], pending[~placed], owner[~placed]
                bucket = self._other(bucket, pending, block)
            if not len(bucket):
                return np.zeros(0, np.int64)
            _, one = np.unique(bucket, return_index=True)  # of each bucket, one fingerprint changes places
            slot = turn % SLOTS
            victim = block[bucket[one], slot].copy()
            block[bucket[one], slot] = pending[one]
            pending[one], owner[one] = victim, -1
            bucket[one] = self._other(bucket[one], victim, block)
        block[:] = before
        if len(high) == 1:
            return np.zeros(1, np.int64)
        half = len(high) // 2
        first = self._fill(block, high[:half], mark[:half])
        return np.concatenate([first, half + self._fill(block, high[half:], mark[half:])])

    @staticmethod
    def _place(block: np.ndarray, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        order = np.argsort(bucket, kind="stable")
        sorted_bucket = bucket[order]
        starts = np.r_[True, sorted_bucket[1:] != sorted_bucket[:-1]][: len(order)]
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(starts, np.arange(len(order)), 0))
        free = block[sorted_bucket] == 0
        fits = rank < free.sum(1)
        slots = np.argsort(~free, axis=1, kind="stable")
        block[sorted_bucket[fits], slots[fits, rank[fits]]] = mark[order[fits]]
        placed = np.zeros(len(bucket), bool)
        placed[order[fits]] = True
        return placed

    def remove(self, high: np.ndarray, low: np.ndarray) -> None:
        """Removes keys that were added, one fingerprint each.

        A fingerprint in one of its two buckets stands for any key of that fingerprint and pair of buckets, so the keys
        of one pair take the slots that hold it in turn.
        """
        mark = self._fingerprint(low)
        waiting = np.arange(len(high))
        for block in reversed(self.blocks):
            first = self._first(high[waiting], block)
            second = self._other(first, mark[waiting], block)
            near, far, own = np.minimum(first, second), np.maximum(first, second), mark[waiting]
            order = np.lexsort((own, near, far))
            new = np.ones(len(order), bool)
            for column in (own, near, far):
                new[1:] &= column[order][1:] == column[order][:-1]
            new[1:] = ~new[1:]
            place = np.arange(len(order))
            rank = np.empty(len(order), np.int64)
            rank[order] = place - np.maximum.accumulate(np.where(new, place, 0))
            slots = np.concatenate([block[near], block[far]], axis=1) == own[:, None]
            slots[:, SLOTS:] &= (near != far)[:, None]
            taken = slots & (np.cumsum(slots, axis=1) == rank[:, None] + 1)
            key, slot = np.nonzero(taken)
            block[np.where(slot < SLOTS, near[key], far[key]), slot % SLOTS] = 0
            waiting = waiting[~taken.any(1)]
