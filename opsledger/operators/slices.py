"""Arrow batches cut by the bytes of a text column and split into words, so that what Python holds at a time does not follow from the rows of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text split into words at a time, in bytes. A single longer text makes a longer slice.
SLICE_BYTES = 1 << 19


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of consecutive rows that hold about `limit` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop - start
        start = stop


def words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(row, word) of every word of the texts in order, cut at the white space that `tokenize` cuts at; null has none."""
    found = pc.utf8_split_whitespace(texts)
    word, row = found.flatten(), pc.list_parent_indices(found)
    # White space at an end leaves an empty word there.
    full = pc.greater(pc.binary_length(word), 0)
    return row.filter(full).to_numpy(zero_copy_only=False).astype(np.int64), word.filter(full).dictionary_encode()


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 as bytes, compressed; byte by byte, without the bytes that no number has."""
    width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return width.to_bytes(1, "little") + len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    """The numbers that `pack` was given."""
    width, size = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], size, codec="zstd", asbytes=True), np.uint8).reshape(width, -1)
    made = planes[0].astype(np.int64)
    for k in range(1, width):
        made |= planes[k].astype(np.int64) << 8 * k
    return made


def pack_words(words: pa.Array) -> bytes:
    """Strings without nulls as bytes, compressed."""
    words = pa.concat_arrays([words.cast(pa.string())])
    size, (_, ends, data) = len(words), words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + size + 1] if size else np.zeros(1, np.int32)
    lengths, text = pack(np.diff(ends)), (data.to_pybytes() if data else b"")[ends[0] : ends[-1]]
    return len(lengths).to_bytes(8, "little") + lengths + len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)


def unpack_words(data: bytes) -> pa.Array:
    """The strings that `pack_words` was given."""
    at = 8 + int.from_bytes(data[:8], "little")
    lengths = unpack(data[8:at])
    text = pa.decompress(data[at + 8 :], int.from_bytes(data[at : at + 8], "little"), codec="zstd", asbytes=True)
    return pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.py_buffer(text)])


def hashes(words: pa.Array) -> np.ndarray:
    """A number of 64 bits for each string without nulls, the same wherever it is."""
    words = pa.concat_arrays([words.cast(pa.string())])
    if not len(words):
        return np.empty(0, np.uint64)
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    letters = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1) if ends[-1] > ends[0] else np.empty(0, np.uint64)
    ends, sizes = ends - ends[0], np.diff(ends)
    # A letter's number times a power of an odd number for its place; sums of a word are differences of sums over all, modulo 2**64.
    powers = np.cumprod(np.full(max(int(sizes.max()), 1), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(letters)) - np.repeat(ends[:-1], sizes)
    sums = np.append(np.uint64(0), np.cumsum(letters * powers[place]))
    made = sums[ends[1:]] - sums[ends[:-1]]
    for shift in (32, 29):
        made = (made ^ (made >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
    return made ^ (made >> np.uint64(32))
