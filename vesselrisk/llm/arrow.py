"""Small helpers for operators that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cuts a batch so that the texts of a piece stay near ``most`` bytes (a longer text is a piece of its own).

    Gives the piece and its texts in UTF-8; null texts are empty.
    """
    at = batch.schema.get_field_index(column)
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0)).astype(np.int64)
    start, n = 0, batch.num_rows
    ends = np.cumsum(lengths)
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        piece = batch.slice(start, stop - start)
        yield piece, [b"" if x is None else x for x in piece.column(at).cast(pa.binary()).to_pylist()]
        start = stop


def with_columns(batch: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch's ``keep`` columns, then the new ones."""
    cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
    return pa.RecordBatch.from_arrays([*cols, *new.values()], names=[*keep, *new])
