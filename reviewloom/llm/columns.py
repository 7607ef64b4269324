"""Arrow columns as numpy arrays, inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column and the n + 1 offsets of its rows; a null is an empty row."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[at[0] : at[-1]], at - at[0]


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column whose rows take ``lengths`` values each."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that few of its texts are Python strings at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def give_back() -> None:
    """Returns what this worker has freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def gives_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a task's function, returning freed memory before and after: workers that wait keep none of it."""

    def tidy(batches: Iterator) -> Iterator:
        give_back()
        yield from run(batches)
        give_back()

    return tidy


def unused(name: str, taken: list[str]) -> str:
    """``name``, longer by underscores until no column in ``taken`` has it."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name
