"""Arrow batch helpers for the text kernels: bounded slices, byte buffers, word ids."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes one kernel call works on; a longer single text is a slice of its own.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most `limit` bytes of text and `rows` rows, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            stop = min(stop, start + rows)
            yield batch.slice(start, stop - start)
            start = stop
    release()


def release() -> None:
    """Give freed memory back to the system: a worker lives on beside those of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column with nulls as empty texts, as a fresh unsliced array."""
    filled = pc.fill_null(batch.column(column).cast(pa.string()), "")
    return pa.concat_arrays([filled, pa.array([], pa.string())])


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and their n + 1 offsets."""
    n = len(array)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + n + 1].astype(np.int64)
    data = array.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def lut(*wanted: int) -> np.ndarray:
    """A 256-entry Boolean table that is true at `wanted`."""
    out = np.zeros(256, bool)
    out[list(wanted)] = True
    return out


#: Space and 0x09-0x0D, what separates words.
SPACE = lut(0x20, *range(0x09, 0x0E))


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of `flags` are set in each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def words(array: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All whitespace-separated words of `array` and the text each comes from."""
    split = pc.ascii_split_whitespace(array)
    flat, parent = pc.list_flatten(split), pc.list_parent_indices(split)
    real = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(real), parent.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
