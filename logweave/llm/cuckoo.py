"""A cuckoo filter: 16-bit fingerprints in buckets of four, with insertion, deletion and resizing."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

SLOTS = 4
KICKS = 200
_SPREAD = 0x5BD1E995


class CuckooFilter:
    """Which digests may be present: never a false no, a false yes about once in 8,000 questions.

    The filter holds no keys. Where an insertion finds no place it answers False, and the owner of
    the keys builds a larger filter from them (`resized`).
    """

    def __init__(self, bits: int = 8, table: np.ndarray | None = None) -> None:
        self.bits = bits
        self.table = np.zeros((1 << bits, SLOTS), np.uint16) if table is None else table
        self._turn = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint and its two buckets; either is found from the other and the fingerprint."""
        mark = int.from_bytes(digest[-2:], "little") or 1
        mask = (1 << self.bits) - 1
        first = int.from_bytes(digest[-10:-2], "little") & mask
        return mark, first, first ^ (mark * _SPREAD & mask)

    def __contains__(self, digest: bytes) -> bool:
        mark, one, other = self._places(digest)
        return mark in self.table[one].tolist() or mark in self.table[other].tolist()

    def insert(self, digest: bytes) -> bool:
        """False if the filter is too full; it then lacks one fingerprint and must be resized."""
        mark, one, other = self._places(digest)
        for at in (one, other):
            own = self.table[at].tolist()
            if 0 in own:
                self.table[at, own.index(0)] = mark
                return True
        at = other
        mask = (1 << self.bits) - 1
        for _ in range(KICKS):
            self._turn = (self._turn + 1) % SLOTS
            mark, self.table[at, self._turn] = int(self.table[at, self._turn]), mark
            at ^= mark * _SPREAD & mask
            own = self.table[at].tolist()
            if 0 in own:
                self.table[at, own.index(0)] = mark
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        """Take out one insertion of a digest that is present; True if there was one."""
        mark, one, other = self._places(digest)
        for at in (one, other):
            own = self.table[at].tolist()
            if mark in own:
                self.table[at, own.index(mark)] = 0
                return True
        return False

    @classmethod
    def resized(cls, bits: int, digests: Iterable[bytes]) -> CuckooFilter:
        """The smallest filter of 2**bits buckets or more that takes all the digests."""
        digests = list(digests)
        while True:
            new = cls(bits)
            if all(new.insert(x) for x in digests):
                return new
            bits += 1

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, body: bytes) -> CuckooFilter:
        table = np.frombuffer(body, "<u2").reshape(-1, SLOTS).astype(np.uint16)
        return cls(len(table).bit_length() - 1, table)
