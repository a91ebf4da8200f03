"""Byte-level BPE ids of many texts: pre-tokens found with array operations, each distinct one merged once."""

from __future__ import annotations

import functools
import json

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

from opsledger.llm.spans import SpanIds, code_points

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OTHER, LETTER, NUMBER, WHITE = range(4)
# The code points with the Unicode property White_Space.
_WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def _classes() -> np.ndarray:
    out = np.zeros(0x110000, dtype=np.uint8)
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    out[_WHITE] = WHITE
    return out


def pre_tokens(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens that PATTERN finds in each text."""
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    kind = _classes()[codes]
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    start = border[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last of some white space before something else stands alone, or leads it if it is a space.
    last = np.flatnonzero((kind[:-1] == WHITE) & (kind[1:] != WHITE) & ~border[1:-1])
    start[last] = True
    start[last[codes[last] == 32] + 1] = False
    quote = np.flatnonzero(start & (codes == 39))
    if len(quote):
        padded = np.concatenate([codes, np.zeros(3, np.uint32)])
        room = offsets[np.searchsorted(offsets, quote, side="right")] - quote
        one, two = padded[quote + 1], padded[quote + 2]
        short = (room > 1) & np.isin(one, [ord(c) for c in "stmd"])
        pair = one.astype(np.int64) << 16 | two
        wide = ~short & (room > 2) & np.isin(pair, [ord(a) << 16 | ord(b) for a, b in ("re", "ve", "ll")])
        for at, size in ((quote[short], 2), (quote[wide], 3)):
            start[at + 1] = False
            after = at + size
            start[after[after < n]] = True
    return np.flatnonzero(start)


class ByteTokens:
    """Ids as the tokenizer file's own library gives them, without special tokens added."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.merger = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spans = SpanIds(self._encode)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        one = self.merger.encode_ordinary
        made = [one(p) for p in pieces]
        length = np.array([len(m) for m in made], dtype=np.int64)
        return np.array([i for m in made for i in m], dtype=np.int32), length

    def pre_token_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, ids of each pre-token, starts of pre-tokens in code points, starts of texts)."""
        codes, offsets = code_points(texts)
        start = pre_tokens(codes, offsets)
        ids, length = self.spans(codes, start, np.append(start[1:], len(codes)))
        return ids, length, start, offsets

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, where the ids of each text begin)."""
        ids, length, start, offsets = self.pre_token_ids(texts)
        ends = np.concatenate([[0], np.cumsum(length)])
        bounds = ends[np.searchsorted(start, offsets)]
        marked = [k for k, t in enumerate(texts) if any(s in t for s in self.special)]
        if marked:  # a special token written out in a text is one id: left to the library
            parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            for k in marked:
                parts[k] = np.array(self.library.encode(texts[k], add_special_tokens=False).ids, dtype=np.int32)
            ids = np.concatenate(parts)
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, bounds


@functools.cache
def byte_tokens(path: str) -> ByteTokens:
    """One per worker process and file."""
    return ByteTokens(path)
