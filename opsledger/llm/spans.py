"""Encode spans of many texts once each: hash, look up, encode what is new, gather the results."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np

from opsledger.llm import rolling

# Spans from this length on are hashed one by one with a cryptographic hash.
LONG = 64
# A worker forgets its encoded spans beyond this number.
KEPT = 400_000
_SYMBOL = rolling.mix(np.arange(0x110000, dtype=np.uint64), 53) | np.uint64(1)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, and where each text begins."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    found = rolling.span_hash(rolling.prefix(_SYMBOL[codes]), start, end, 5)
    for k in np.flatnonzero(end - start >= LONG):
        found[k] = int.from_bytes(hashlib.blake2b(codes[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return found


def gather(pool: np.ndarray, offset: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pool's runs [offset, offset + length), one after another."""
    total = np.cumsum(length)
    at = np.repeat(offset - (total - length), length)
    at += np.arange(len(at))
    return pool[at]


class SpanIds:
    """Ids of spans. `encode(strings)` gives (flat ids, lengths) of spans not seen before."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.place = np.empty(0, np.int64)
        self.offset = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)
        self.pool = np.empty(0, np.int32)

    def __call__(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids of each span)."""
        if not len(start):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        unique, first, back = np.unique(hashes(codes, start, end), return_index=True, return_inverse=True)
        if len(self.known) > KEPT:
            self._clear()
        at = np.searchsorted(self.known, unique)
        old = np.zeros(len(unique), dtype=bool)
        inside = at < len(self.known)
        old[inside] = self.known[at[inside]] == unique[inside]
        new = np.flatnonzero(~old)
        if len(new):
            s, e = start[first[new]], end[first[new]]
            text = gather(codes, s, e - s).tobytes().decode("utf-32-le", "surrogatepass")
            cut = np.concatenate([[0], np.cumsum(e - s)]).tolist()
            ids, length = self.encode([text[a:b] for a, b in zip(cut[:-1], cut[1:])])
            count = len(self.place)
            self.offset = np.concatenate([self.offset, len(self.pool) + np.cumsum(length) - length])
            self.length = np.concatenate([self.length, length])
            self.pool = np.concatenate([self.pool, ids])
            self.known = np.insert(self.known, at[new], unique[new])
            self.place = np.insert(self.place, at[new], np.arange(count, count + len(new)))
            at = np.searchsorted(self.known, unique)
        place = self.place[at][back]
        return gather(self.pool, self.offset[place], self.length[place]), self.length[place]
