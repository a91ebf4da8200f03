"""Harmonic packing: pieces in reciprocal-capacity classes, each bin filled with a fixed number of pieces.

A document's ids are cut into whole sequences, then along the binary digits of what remains down to `GRAIN`,
then one piece below that. A piece of length L is of class `capacity // L`: that many fill a bin, so the
bins of the halving classes are full to the last id. Every task fills its own bins, independently and in one
pass: no shuffle. What is left in open bins at a task's end (under one bin per class) is laid end to end and
cut into whole sequences and powers of two.

Null texts count as empty; a document always has at least its closing id. Repeated rows are packed again.
Rows keep their doc_id, null included; other columns are ignored. An empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from opsledger.llm.batches import steps, text_column
from opsledger.llm.byte_tokens import byte_tokens

CAPACITY = 1024
GRAIN = 32
CLOSE = 0
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, padding long"


def cuts(n: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    made, at = [], 0
    while n - at >= capacity:
        made.append((at, capacity))
        at += capacity
    size = capacity // 2
    while size >= grain:
        if n - at >= size:
            made.append((at, size))
            at += size
        size //= 2
    if n > at:
        made.append((at, n - at))
    return made


def padded(n: int, capacity: int = CAPACITY) -> int:
    """The stored length of a sequence of n ids: capacity, or n itself where it is a power of two."""
    return n if n & (n - 1) == 0 else capacity


class Bins:
    """Open bins of one task, by piece length; a bin is handed out once it is full."""

    def __init__(self, first: int, capacity: int = CAPACITY):
        self.next, self.capacity = first, capacity
        self.open: dict[int, list] = {}

    def _close(self, pieces: list) -> list[tuple]:
        total = sum(len(p[2]) for p in pieces)
        at, rows = 0, []
        for doc, start, ids, n in pieces:
            rows.append((doc, start, len(ids), zlib.crc32(ids), n, self.next, at, total, padded(total, self.capacity) - total))
            at += len(ids)
        self.next += 1
        return rows

    def add(self, doc: int | None, start: int, ids: np.ndarray, n: int) -> list[tuple]:
        waiting = self.open.setdefault(len(ids), [])
        waiting.append((doc, start, ids, n))
        if len(waiting) < self.capacity // len(ids):
            return []
        return self._close(self.open.pop(len(ids)))

    def finish(self) -> list[tuple]:
        """Lay what is left end to end; cut it at whole sequences, then at the binary digits of the rest."""
        left = [p for size in sorted(self.open, reverse=True) for p in self.open[size]]
        self.open = {}
        rows: list[tuple] = []
        for _, room in cuts(sum(len(p[2]) for p in left), self.capacity, 1):
            bin_, used = [], 0
            while used < room:
                doc, start, ids, n = left.pop(0)
                take = min(len(ids), room - used)
                bin_.append((doc, start, ids[:take], n))
                if take < len(ids):
                    left.insert(0, (doc, start + take, ids[take:], n))
                used += take
            rows += self._close(bin_)
        return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(TaskContext.get().partitionId() << 36)
        encoder = byte_tokens(path)
        for batch in steps(batches):
            ids, bounds = encoder.encode(text_column(batch.column("text")).to_pylist())
            rows: list[tuple] = []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                own = np.append(ids[a:b], CLOSE).astype("<u4")
                for start, length in cuts(len(own)):
                    rows += bins.add(doc, start, own[start : start + length], len(own))
            if rows:
                yield _batch(rows)
        if rows := bins.finish():
            yield _batch(rows)

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, _PIECES)
