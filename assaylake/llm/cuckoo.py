"""Cuckoo filter over 128-bit keys in numpy: insert, delete, vectorised lookup; and shards of them."""

from __future__ import annotations

import io

import numpy as np

SLOTS = 4
MAX_KICKS = 500


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; zero marks a free slot. May say yes to an absent key, never no to a present one."""

    def __init__(self, capacity: int):
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * 0.85)))))
        self.table = np.zeros((buckets, SLOTS), dtype=np.uint16)
        self.size = 0

    @property
    def nbytes(self) -> int:
        return self.table.nbytes

    @staticmethod
    def _mark(lo: np.ndarray) -> np.ndarray:
        mark = (lo & np.uint64(0xFFFF)).astype(np.uint16)
        return np.where(mark == 0, np.uint16(1), mark)

    def _places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        mark = self._mark(lo)
        first = (hi & mask).astype(np.int64)
        return mark, first, first ^ self._jump(mark)

    def _jump(self, mark: np.ndarray) -> np.ndarray:
        return ((mark.astype(np.uint64) * np.uint64(0x5BD1E995) ^ np.uint64(0x9E37)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        mark, a, b = self._places(hi, lo)
        return (self.table[a] == mark[:, None]).any(axis=1) | (self.table[b] == mark[:, None]).any(axis=1)

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Adds each key once more; grows is the caller's task: a full filter raises OverflowError and is left unchanged."""
        before, size = self.table.copy(), self.size
        marks, firsts, seconds = self._places(hi, lo)
        order = np.random.default_rng(len(marks))
        for mark, a, b in zip(marks.tolist(), firsts.tolist(), seconds.tolist(), strict=True):
            for at in (a, b):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = mark
                    break
            else:
                at = b
                for _ in range(MAX_KICKS):
                    slot = int(order.integers(SLOTS))
                    mark, self.table[at, slot] = int(self.table[at, slot]), mark
                    at ^= int(self._jump(np.array([mark], dtype=np.uint16))[0])
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = mark
                        break
                else:
                    self.table, self.size = before, size
                    raise OverflowError("cuckoo filter is full")
            self.size += 1

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Takes one copy of each key out; only keys that were inserted may be given."""
        marks, firsts, seconds = self._places(hi, lo)
        for mark, a, b in zip(marks.tolist(), firsts.tolist(), seconds.tolist(), strict=True):
            for at in (a, b):
                own = np.flatnonzero(self.table[at] == mark)
                if len(own):
                    self.table[at, own[0]] = 0
                    self.size -= 1
                    break
            else:
                raise KeyError("a key that was never inserted can't be deleted")

    @classmethod
    def of(cls, hi: np.ndarray, lo: np.ndarray, room: int = 0) -> CuckooFilter:
        """A filter with these keys and room for more; doubled until all find a place."""
        capacity = len(hi) + room
        while True:
            own = cls(capacity)
            try:
                own.insert(hi, lo)
                return own
            except OverflowError:
                capacity = 2 * max(1, capacity)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.save(out, self.table, allow_pickle=False)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, content: bytes) -> CuckooFilter:
        own = cls(1)
        own.table = np.load(io.BytesIO(content), allow_pickle=False)
        own.size = int((own.table != 0).sum())
        return own


class Shards:
    """Filters by the top bits of a key's high half; a shard without keys has none."""

    def __init__(self, bits: int, filters: dict[int, CuckooFilter]):
        self.bits, self.filters = bits, filters

    @property
    def nbytes(self) -> int:
        return sum(f.nbytes for f in self.filters.values())

    def shard(self, hi: np.ndarray) -> np.ndarray:
        return (hi >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hi), dtype=np.int64)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out, shard = np.zeros(len(hi), dtype=bool), self.shard(hi)
        for s in np.unique(shard).tolist():
            if s in self.filters:
                own = shard == s
                out[own] = self.filters[s].contains(hi[own], lo[own])
        return out
