"""A cuckoo filter over 128-bit keys, as numpy arrays that travel as bytes."""

from __future__ import annotations

from collections import Counter

import numpy as np

from scriptorium.llm.common import mix64

SLOTS, MOST_KICKS = 4, 500


class CuckooFilter:
    """Membership with deletion: no false negatives for keys inserted and not deleted; false positives about 8 / 65,536.

    Buckets hold SLOTS 16-bit fingerprints (0: free). A key's second bucket is its first one xor a hash of its
    fingerprint. When kicks run out, the last fingerprint goes to an exact side list, which counts what it holds: a filter
    filled beyond its capacity loses no key, also by deletion. As fingerprints alone cannot be dealt anew, a filter
    without room for more keys is to be built again from the keys, larger.
    """

    def __init__(self, capacity: int):
        need = max(4, int(capacity / 0.85 / SLOTS) + 1)
        self.bits = max(2, (need - 1).bit_length())
        self.table = np.zeros((1 << self.bits, SLOTS), np.uint16)
        self.overflow: Counter[tuple[int, int]] = Counter()

    def room(self, keys: int) -> bool:
        """Whether so many more keys fit without long searches for a free place."""
        return not self.overflow and int(np.count_nonzero(self.table)) + keys <= 0.9 * self.table.size

    @staticmethod
    def _hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """keys: uint64 pairs, shape (n, 2); a hash for the bucket and a fingerprint."""
        h = mix64(keys[:, 0] ^ mix64(keys[:, 1], 1), 2)
        f = (mix64(keys[:, 1] ^ keys[:, 0], 3) & np.uint64(0xFFFF)).astype(np.uint16)
        return h, np.where(f == 0, np.uint16(1), f)

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        return (bucket ^ mix64(print_.astype(np.uint64), 4)) & np.uint64((1 << self.bits) - 1)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, f = self._hash(keys)
        one = h & np.uint64((1 << self.bits) - 1)
        return one, self._other(one, f), f

    def insert(self, keys: np.ndarray) -> None:
        if not len(keys):
            return
        ones, twos, prints = self._places(keys)
        for a, b, f in zip(ones.tolist(), twos.tolist(), prints.tolist(), strict=True):
            if not (self._put(a, f) or self._put(b, f)):
                self._kick(a, f)

    def _put(self, bucket: int, f: int) -> bool:
        row = self.table[bucket]
        for s in range(SLOTS):
            if row[s] == 0:
                row[s] = f
                return True
        return False

    def _kick(self, bucket: int, f: int) -> None:
        for turn in range(MOST_KICKS):
            s = (turn * 7 + f) % SLOTS
            f, self.table[bucket, s] = int(self.table[bucket, s]), f
            bucket = int(self._other(np.array([bucket], np.uint64), np.array([f], np.uint16))[0])
            if self._put(bucket, f):
                return
        self.overflow[bucket, f] += 1  # an exact side list: never a lost key

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        one, two, f = self._places(keys)
        hit = (self.table[one] == f[:, None]).any(1) | (self.table[two] == f[:, None]).any(1)
        if self.overflow:
            for i in np.flatnonzero(~hit):
                hit[i] = (int(one[i]), int(f[i])) in self.overflow or (int(two[i]), int(f[i])) in self.overflow
        return hit

    def delete(self, keys: np.ndarray) -> None:
        """Only for keys that were inserted."""
        if not len(keys):
            return
        for a, b, f in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            for bucket in (a, b):
                found = np.flatnonzero(self.table[bucket] == f)
                if len(found):
                    self.table[bucket, found[0]] = 0
                    break
                if (bucket, f) in self.overflow:
                    self.overflow[bucket, f] -= 1
                    if not self.overflow[bucket, f]:
                        del self.overflow[bucket, f]
                    break

    def to_bytes(self) -> bytes:
        extra = np.array(sorted(self.overflow.elements()), np.uint64).reshape(-1, 2)
        return np.array([self.bits, len(extra)], np.uint64).tobytes() + extra.tobytes() + self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        bits, n = (int(x) for x in np.frombuffer(data, np.uint64, 2))
        out = cls.__new__(cls)
        out.bits = bits
        out.overflow = Counter((int(a), int(b)) for a, b in np.frombuffer(data, np.uint64, 2 * n, 16).reshape(-1, 2))
        out.table = np.frombuffer(data, np.uint16, SLOTS << bits, 16 + 16 * n).reshape(-1, SLOTS).copy()
        return out
