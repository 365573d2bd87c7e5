"""Arrow string columns as flat numpy arrays, a bounded slice of rows at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: A slice holds whole rows of about this many bytes, or one longer row.
SLICE_BYTES = 3 << 20


def release() -> None:
    """Give what a Python worker holds for later use back to the system: an idle worker needs none of it."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _trim_of_libc():
    import ctypes

    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # other C libraries have no such call
        return None


_TRIM = _trim_of_libc()


def flat_utf8(column: pa.Array, binary: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty, bytes that are no UTF-8 become U+FFFD unless it is binary."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = column.cast(pa.large_binary())
    if wide.null_count:
        wide = wide.fill_null(b"")
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(wide) else np.zeros(0, np.uint8)
    at = at - at[0] if len(at) else np.zeros(1, np.int64)
    if binary:
        return raw, at
    try:
        raw.tobytes().decode("utf-8")
    except UnicodeDecodeError:
        fixed = [bytes(x).decode("utf-8", "replace").encode() for x in wide.to_pylist()]
        raw = np.frombuffer(b"".join(fixed), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(x) for x in fixed])]).astype(np.int64)
    return raw, at


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES, binary: bool = False) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) with about ``limit`` bytes of the column, or one longer row; memory doesn't grow with a batch."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        sizes = np.cumsum(np.nan_to_num(np.asarray(pa.compute.binary_length(values).to_numpy(zero_copy_only=False), float)))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + limit, "right")))
            rows = batch.slice(start, stop - start)
            yield rows, *flat_utf8(rows.column(rows.schema.get_field_index(column)), binary)
            start = stop
