"""Arrow batches in slices that a Python worker can hold, whatever the length of their texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: A slice holds whole rows of about this many bytes of the column, or one longer row.
SLICE_BYTES = 4 << 20


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in order, about ``limit`` bytes of a text or binary column at a time."""
    for batch in batches:
        sizes = np.asarray(pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))).to_numpy(zero_copy_only=False), float)
        ends = np.cumsum(np.nan_to_num(sizes))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0.0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
