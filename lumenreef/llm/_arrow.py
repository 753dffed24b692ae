"""Small helpers for functions that map Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

#: Rows that one step of a text operator handles together, so that memory
#: follows the texts of a few rows and not of a whole Arrow batch.
SLICE_ROWS = 256


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most ``rows`` rows (no copy)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]
