"""Small helpers around Arrow batches that the text operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about this many bytes, whatever the size of Spark's batches.
SLICE_BYTES = 4 << 20


def slices(
    batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES, rows: int = 1 << 30
) -> Iterator[pa.RecordBatch]:
    """Rows of ``batch`` in order, about ``limit`` bytes of text or ``rows`` at a time and one row at least."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    at = 0
    while at < len(batch):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(min(at + rows, np.searchsorted(ends, done + limit, "right"))))
        yield batch.slice(at, stop - at)
        at = stop


def longs(batch: pa.RecordBatch, column: str, null: int) -> np.ndarray:
    """A long column as numpy, NULL as ``null``."""
    return pc.fill_null(batch.column(column).cast(pa.int64()), null).to_numpy(zero_copy_only=False)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A text column as Python strings, NULL as the empty one."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` that gives what it no longer uses back to the machine when its task ends.

    Spark's workers live on from task to task, and what one kind of task has freed counts as theirs until it is given back.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return whole
