"""Words and word windows of whole texts as 64-bit hashes, computed over Arrow buffers with numpy.

A text travels as UTF-8 bytes. All separators used here are ASCII, so cutting bytes
and cutting characters give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_SLICE = 1 << 21  # bytes of text handled at once; one longer text is a slice of its own
_PIECE = 1 << 17  # bytes hashed at once, so that the work stays in the CPU's cache
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~SPACES  # words [^\x20\x09-\x0D]+
ALNUM = np.ones(256, bool)  # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of text with A-Z lowered
ALNUM[:0x30] = ALNUM[0x3A:0x61] = ALNUM[0x7B:0x80] = False
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Tables:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.n = 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * _PIECE)
            self.up, self.down = _powers(_BASE, self.n), _powers(pow(_BASE, -1, 1 << 64), self.n)
        return self.up, self.down


_tables = _Tables()


class Words(NamedTuple):
    """Words of some texts: byte ranges in `data`, hashes, and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of text i: words first[i]:first[i + 1]

    def room(self) -> np.ndarray:
        """For each word, how many words of its text begin at it or later."""
        n = np.diff(self.first)
        return np.repeat(self.first[1:], n) - np.arange(len(self.starts))


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray) -> np.ndarray:
    values = _VALUES[fold]
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        base = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + _PIECE, "right")))
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        n = int(e[-1])
        up, down = _tables.get(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data[base : base + n]] * up[:n], dtype=np.uint64, out=sums[1:])
        out[lo:hi] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        lo = hi
    return mix(out)


def tokenise(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: np.ndarray) -> Words:
    """Words of the texts data[offsets[i]:offsets[i + 1]]; `fold` maps bytes before anything else."""
    if len(data) == 0:
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.empty(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = is_word[fold][data]
    edge = np.empty(len(data), bool)
    edge[0], edge[1:] = True, ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    edge[cuts] = True
    starts = np.flatnonzero(inside & edge)
    edge[-1], edge[:-1] = True, ~inside[1:]
    edge[cuts - 1] = True
    # Cuts between texts end a word too; all other positions were rewritten just now.
    ends = np.flatnonzero(inside & edge) + 1
    return Words(data, starts, ends, _hash(data, starts, ends, fold), np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows of the array (len - n + 1 of them), built by doubling."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out, have, step, width = None, 0, hashes, 1
    while n:
        if n & 1:
            if out is None:
                out, have = step, width
            else:
                size = min(len(out), len(step) - have)
                out, have = _join(out[:size], step[have : have + size]), have + width
        n >>= 1
        if n:
            step, width = _join(step[:-width], step[width:]), 2 * width
    return mix(out)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _U(0xD6E8FEB86659FD93) + b
    x ^= x >> _U(32)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(29)
    return x


def covered(at: np.ndarray, n_words: int, width: int) -> np.ndarray:
    """Which of the words lie in a window of `width` words that begins at one of `at`."""
    change = np.zeros(n_words + 1, np.int32)
    np.add.at(change, at, 1)
    np.add.at(change, np.minimum(at + width, n_words), -1)
    return np.cumsum(change[:-1]) > 0


def texts(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (first row, end row, bytes, offsets) of a binary column; a null is an empty text."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    row = 0
    for chunk in chunks:
        wide = pa.types.is_large_binary(chunk.type)
        chunk = chunk.cast(pa.binary()) if not wide and chunk.type != pa.binary() else chunk
        if chunk.null_count:
            chunk = chunk.fill_null(b"")
        if len(chunk) == 0:
            continue
        _, bounds, body = chunk.buffers()
        kind = np.int64 if wide else np.int32
        offsets = np.frombuffer(bounds, kind)[chunk.offset : chunk.offset + len(chunk) + 1].astype(np.int64)
        data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
        lo = 0
        while lo < len(chunk):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _SLICE, "right")) - 1)
            own = offsets[lo : hi + 1]
            yield row + lo, row + hi, data[own[0] : own[-1]], own - own[0]
            lo = hi
        row += len(chunk)


def reps(keys: np.ndarray, most: int = 2) -> np.ndarray:
    """The keys in order, each at most `most` times: enough to see which occur twice."""
    keys = np.sort(keys)
    return keys[np.concatenate([np.ones(min(most, len(keys)), bool), keys[most:] != keys[:-most]])]


def member(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which keys are in the ordered array."""
    if not len(ordered):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(ordered, keys)
    at[at == len(ordered)] = 0
    return ordered[at] == keys
