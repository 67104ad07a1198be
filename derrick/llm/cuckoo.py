"""A small cuckoo filter over 64-bit keys: membership with deletions.

A key has a 16-bit fingerprint and two buckets of four slots; the second bucket is
the first xor a hash of the fingerprint, so either can be found from the other.
Lookups are vectorised; insertions move fingerprints along as needed. A false
positive costs its users one exact lookup and never changes a result; there are no
false negatives as long as only inserted keys are removed.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _prints(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)


class CuckooFilter:
    def __init__(self, table: np.ndarray) -> None:
        self.table = table  # buckets (a power of two) x SLOTS of uint16; 0 is free
        self.mask = np.uint64(len(table) - 1)

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        """Room for ``n`` keys at a load of at most four fifths."""
        buckets = 1 << max(1, int(np.ceil(np.log2(max(n, 1) / (SLOTS * 0.8) + 1))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, dtype="<u2").reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @property
    def room(self) -> int:
        """Keys that still fit below a load of nine tenths."""
        return int(self.table.size * 0.9) - int((self.table > 0).sum())

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.asarray(keys, dtype=np.int64).view(np.uint64)
        prints = _prints(keys)
        first = (keys * _MIX >> np.uint64(16)) & self.mask
        return prints, first, self._other(first, prints)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ ((prints.astype(np.uint64) * _MIX >> np.uint64(20)) & self.mask)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, dtype=bool)
        prints, a, b = self._places(keys)
        want = prints[:, None]
        return ((self.table[a] == want) | (self.table[b] == want)).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Add all keys; False if one found no slot, and then the filter is spoilt
        and has to be built anew in a larger size."""
        for f, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (a, b):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = f
                    break
            else:
                if not self._move(f, a):
                    return False
        return True

    def _move(self, f: int, bucket: int) -> bool:
        for step in range(500):
            slot = step % SLOTS
            out = int(self.table[bucket, slot])
            self.table[bucket, slot] = f
            f = out
            bucket = int(self._other(np.array([bucket], dtype=np.uint64), np.array([f], dtype=np.uint16))[0])
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = f
                return True
        return False

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that were inserted before."""
        for f, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (a, b):
                at = np.flatnonzero(self.table[bucket] == f)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break


def built(keys: np.ndarray) -> CuckooFilter:
    """A filter of the given keys, as large as their insertion needs."""
    size = len(keys)
    while True:
        out = CuckooFilter.sized(size)
        if out.insert(keys):
            return out
        size *= 2
