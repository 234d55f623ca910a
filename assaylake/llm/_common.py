"""Shared plumbing of the training-data operators: Arrow batches, names, and the library's written tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from assaylake.plans.storage import cut, shared_dir, written

__all__ = ["cut", "quoted", "raw_text", "shared_dir", "slices", "written"]

#: Rows of one slice handed to a Python kernel; long texts make slices smaller, see `slices`.
SLICE_ROWS = 2048
#: Bytes of one slice.
SLICE_BYTES = 16 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str | None = None, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one slice holds few rows and, for `column`, about `most` bytes at most (one row at least)."""
    for batch in batches:
        step, n, at = SLICE_ROWS, batch.num_rows, 0
        size = batch.column(column).nbytes if column and n else 0
        step = max(1, min(step, n, int(n * most / size) if size > most else step))
        while at < n:
            yield batch.slice(at, step)
            at += step


def raw_text(column: str):
    """A text column as UTF-8 bytes, so that Python kernels read it without decoding."""
    return F.col(column).cast("binary")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
