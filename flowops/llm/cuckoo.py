"""A cuckoo filter on 64-bit key hashes: set membership with deletion, worked on in whole arrays."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 500
LOAD = 0.8


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    return x


class CuckooFilter:
    """Buckets of four 16-bit marks; a key is in one of two buckets, or in a short overflow list.

    ``remove`` must only be called for keys that were added. A key is expected once: reference counts
    live in the exact table behind the filter.
    """

    def __init__(self, capacity: int):
        buckets = 1
        while buckets * SLOTS * LOAD < capacity:
            buckets *= 2
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        self.spare: list[tuple[int, int]] = []

    @classmethod
    def loaded(cls, table: bytes, spare: bytes) -> CuckooFilter:
        self = cls(0)
        self.table = np.frombuffer(table, np.uint16).reshape(-1, SLOTS).copy()
        self.spare = [tuple(x) for x in np.frombuffer(spare, np.int64).reshape(-1, 2).tolist()]
        return self

    def dumped(self) -> tuple[bytes, bytes]:
        return self.table.tobytes(), np.array(self.spare, np.int64).reshape(-1, 2).tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = _mixed(keys.view(np.uint64) if keys.dtype != np.uint64 else keys)
        mark = (h >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (h & np.uint64(len(self.table) - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        turn = _mixed(mark.astype(np.uint64) * np.uint64(0x5BD1E995C6A4A793))
        return bucket ^ (turn & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _fill(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Put what fits into free slots of the given buckets; a mask of what was put."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        rank = np.arange(len(b)) - np.searchsorted(b, b)
        free = self.table[b] == 0
        slot = np.argmax(np.cumsum(free, axis=1) == (rank + 1)[:, None], axis=1)
        fits = free.sum(axis=1) > rank
        self.table[b[fits], slot[fits]] = mark[order][fits]
        done = np.zeros(len(b), bool)
        done[order[fits]] = True
        return done

    def add(self, keys: np.ndarray) -> None:
        mark, first, second = self._places(keys)
        rest = ~self._fill(first, mark)
        left = np.flatnonzero(rest)
        left = left[~self._fill(second[left], mark[left])]
        rng = np.random.default_rng(len(left))
        for i in left:
            m, b = int(mark[i]), int(second[i])
            for _ in range(KICKS):
                row = self.table[b]
                free = np.flatnonzero(row == 0)
                if len(free):
                    row[free[0]] = m
                    break
                s = int(rng.integers(SLOTS))
                m, row[s] = int(row[s]), m
                b = int(self._other(np.array([b]), np.array([m], np.uint16))[0])
            else:
                self.spare.append((b, m))

    def has(self, keys: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(keys)
        found = (self.table[first] == mark[:, None]).any(axis=1) | (self.table[second] == mark[:, None]).any(axis=1)
        for b, m in self.spare:
            found |= (mark == m) & ((first == b) | (second == b))
        return found

    def remove(self, keys: np.ndarray) -> None:
        for m, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (a, b):
                at = np.flatnonzero(self.table[bucket] == m)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break
            else:
                for bucket in (a, b):
                    if (bucket, m) in self.spare:
                        self.spare.remove((bucket, m))
                        break
