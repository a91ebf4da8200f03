"""Arrow batches in, Arrow batches out: bounded slices of text for the vectorised operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

# Text handed to one vectorised step, in bytes. A single longer text makes a longer step.
STEP_BYTES = 1 << 19


def text_column(column: pa.Array) -> pa.Array:
    """The column as plain 64-bit-offset strings, null read as empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return pc.fill_null(column, "") if column.null_count else column


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about `limit` bytes of `column`; never inside a row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for row, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def mapper(step: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str = "text"):
    """A function for `mapInArrow` that applies `step` to bounded slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in steps(batches, column):
            made = step(piece)
            if made is not None:
                yield made

    return run
