"""Words of Arrow string batches as numpy arrays: boundaries, document numbers, 64-bit hashes.

All patterns used here split at ASCII bytes only, so UTF-8 can be cut bytewise: no byte of a
longer character is below 0x80. Hashes are polynomials over a random byte table modulo
2**64 (Rabin-Karp), taken from prefix sums, and mixed at the end. Equal words have equal
hashes in every process; two different words collide with a chance near 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20  # text handled at once; a longer document makes a longer chunk

_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False                      # [^\x20\x09-\x0D]+
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True  # after lower-casing
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20                                      # A-Z only

_TABLE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept per process and grown when needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@dataclass
class Words:
    """The words of some documents. ``first[d]:first[d+1]`` are the words of document d."""

    data: np.ndarray   # bytes of all documents, lower-cased if asked for
    start: np.ndarray  # first byte of each word
    end: np.ndarray    # byte behind each word
    first: np.ndarray  # number of the first word of each document, and the total
    hash: np.ndarray   # 64-bit hash of each word

    def __len__(self) -> int:
        return len(self.start)

    @property
    def docs(self) -> int:
        return len(self.first) - 1

    def doc(self) -> np.ndarray:
        """Document number of each word."""
        return np.repeat(np.arange(self.docs), np.diff(self.first))

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def words(texts: pa.Array, alnum: bool = False, lower: bool = False) -> Words:
    """Cut an Arrow string array into words; null counts as empty.

    ``alnum``: runs of letters, digits and non-ASCII characters (of the lower-cased text);
    else runs of anything but white space.
    """
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    _, offsets, values = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(values, dtype=np.uint8)[offsets[0]:offsets[-1]] if values is not None else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    data = _LOWER[raw] if lower else raw
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = (_ALNUM if alnum else _WORD)[data]
    begin = inside[:-1].copy()
    begin[1:] &= ~inside[:-2]
    edges = bounds[1:-1]
    edges = edges[edges < len(data)]
    begin[edges] = inside[edges]                  # a word ends with its document
    stop = inside[:-1].copy()
    stop[:-1] &= ~inside[1:-1]
    tails = bounds[1:-1]
    tails = tails[tails > 0] - 1
    stop[tails] = inside[tails]
    start = np.flatnonzero(begin)
    end = np.flatnonzero(stop) + 1
    first = np.searchsorted(start, bounds)
    return Words(data, start, end, first, _hash(data, start, end))


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * _power_table(_BASE, len(data)), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power_table(_INVERSE, len(data))[start])


_STEP = 0xA0761D6478BD642F | 1
_STEP_INVERSE = pow(_STEP, -1, 2**64)


def window_hashes(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hash of every ``size`` consecutive words of one document, and the number of
    the word where it starts."""
    counts = np.maximum(np.diff(w.first) - size + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.repeat(w.first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(total)
    sums = np.zeros(len(w) + 1, dtype=np.uint64)
    np.cumsum(w.hash * _power_table(_STEP, len(w)), out=sums[1:])
    return mix((sums[at + size] - sums[at]) * _power_table(_STEP_INVERSE, len(w))[at]), at


def chunks(batch: pa.RecordBatch, text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``most`` bytes of text, or one document."""
    n = batch.num_rows
    if not n:
        return
    column = batch.column(text)
    size = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """``chunks`` of every batch."""
    for batch in batches:
        yield from chunks(batch, text, most)
