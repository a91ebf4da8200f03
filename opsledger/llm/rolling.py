"""Words, shingles and their 64-bit hashes over many texts at once, from one pass over the bytes.

All hashes are polynomials in an odd base modulo 2**64 over randomised symbol values, read off one prefix
sum, then mixed. Two different short strings agree with a chance of about 2**-60. Words and lines from `LONG` bytes on are hashed apart.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Words and lines of so many bytes are hashed with a cryptographic hash.
LONG = 64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.Generator(np.random.PCG64(20240517))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of `base`, modulo 2**64; kept and grown."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        table = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        table[0] = 1
        _powers[base] = have = np.multiply.accumulate(table)
    return have[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    x = x + np.uint64((salt * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % 2**64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of value times base**position, with a leading zero."""
    out = np.empty(len(values) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(values * powers(_BASE, len(values)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hashes of the spans [start, end) under `prefix`. The salt keeps kinds of spans apart."""
    raw = (sums[end] - sums[start]) * powers(_INVERSE, len(sums))[start]
    return mix(raw, salt)


@dataclass
class Texts:
    """Many texts laid end to end: their bytes and where each begins."""

    data: np.ndarray
    offsets: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Texts:
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
        return Texts(raw, at - at[0])

    def lower(self) -> Texts:
        return Texts(_LOWER[self.data], self.offsets)


@dataclass
class Words:
    """Words of many texts in order: byte spans, and the range of words of each text."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words(texts: Texts) -> Words:
    """Maximal runs of bytes other than space, tab, line feed, vertical tab, form feed, return."""
    inside = np.zeros(len(texts.data) + 2, dtype=bool)
    np.logical_not(SPACE[texts.data], out=inside[1:-1])
    change = inside[1:] != inside[:-1]
    # A text ends where the next begins, so a run that touches the border is cut there.
    inner = texts.offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(texts.data))])
    glued = inner[inside[inner] & inside[inner + 1]]
    flips = np.flatnonzero(change)
    start, end = flips[0::2], flips[1::2]
    if len(glued):
        start = np.sort(np.concatenate([start, glued]))
        end = np.sort(np.concatenate([end, glued]))
    return Words(start, end, np.searchsorted(start, texts.offsets))


def byte_hashes(texts: Texts, start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of spans of bytes. Long ones are hashed one by one: a polynomial modulo 2**64 has fixed collisions between long strings."""
    codes = span_hash(prefix(_BYTE[texts.data]), start, end, salt)
    for k in np.flatnonzero(end - start >= LONG):
        codes[k] = int.from_bytes(hashlib.blake2b(texts.data[start[k] : end[k]].tobytes(), digest_size=8, person=bytes([salt])).digest(), "little")
    return codes


def word_hashes(texts: Texts, found: Words) -> np.ndarray:
    return byte_hashes(texts, found.start, found.end, 1)


def windows(hashes: np.ndarray, found: Words, size: int, salt: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of `size` words inside one text, and the word index each begins at."""
    count = np.maximum(found.counts - size + 1, 0)
    total = int(count.sum())
    first = np.repeat(found.bounds[:-1] - (np.cumsum(count) - count), count) + np.arange(total)
    sums = prefix(hashes)
    return span_hash(sums, first, first + size, salt), first


def shingle_sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct `size`-word shingles of each lower-cased text: (row, hash), ordered by row then hash.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    low = texts.lower()
    found = words(low)
    hashes = word_hashes(low, found)
    codes, first = windows(hashes, found, size)
    rows = np.searchsorted(found.bounds, first, side="right") - 1
    short = np.flatnonzero((found.counts > 0) & (found.counts < size))
    if len(short):
        whole = span_hash(prefix(hashes), found.bounds[short], found.bounds[short + 1], 3)
        codes, rows = np.concatenate([codes, whole]), np.concatenate([rows, short])
    order = np.lexsort((codes, rows))
    codes, rows = codes[order], rows[order]
    if len(codes):
        new = np.ones(len(codes), dtype=bool)
        new[1:] = (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1])
        codes, rows = codes[new], rows[new]
    return rows, codes
