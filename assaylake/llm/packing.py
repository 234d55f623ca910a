"""Harmonic packing of token sequences.

Each document is its ids plus one separator id. It is cut into full sequences, then into pieces of
capacity/2, /4, ... down to `grain`, then one remainder below `grain`. A piece whose length lies in
(capacity/(j+1), capacity/j] belongs to class j, and a bin of class j holds exactly j pieces, so the
pieces of the power-of-two classes fill their bins to the last token and a remainder's bin leaves at
most 1/(j+1) of it empty. Every task fills its own bins without a shuffle and without knowing of
others; it holds at most one open bin a class. What is left open at the task's end is joined, cut at
the capacity and, for the last part, at powers of two, which need no padding.

Defined cases: null text is an empty text, and an empty text is the separator alone; repeated rows
are packed each for itself; a null id stays null; an empty table gives no rows; other columns are
ignored. Sequence ids are unique, not consecutive: task number times 2^40 plus a running number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm._common import quoted, slices
from assaylake.llm.tokens import encoder

COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

Piece = tuple[object, int, np.ndarray, int]  # document's id, start, ids, tokens of the document


class Bins:
    """The open bins of one task; `full` gives rows of finished sequences."""

    def __init__(self, capacity: int, grain: int, first_id: int):
        self.capacity, self.grain, self.next_id = capacity, grain, first_id
        self.open: dict[int, list[Piece]] = {}

    def cut(self, n: int) -> Iterator[tuple[int, int]]:
        """(start, length) of each piece of a document of n tokens."""
        at = 0
        while n - at >= self.capacity:
            yield at, self.capacity
            at += self.capacity
        size = self.capacity // 2
        while size >= self.grain:
            if n - at >= size:
                yield at, size
                at += size
            size //= 2
        if n > at:
            yield at, n - at

    def add(self, doc: object, ids: np.ndarray) -> Iterator[tuple]:
        for start, length in self.cut(len(ids)):
            j = self.capacity // length
            held = self.open.setdefault(j, [])
            held.append((doc, start, ids[start : start + length], len(ids)))
            if len(held) == j:
                yield from self.sequence(self.open.pop(j))

    def sequence(self, pieces: list[Piece]) -> Iterator[tuple]:
        at = 0
        for doc, start, ids, total in pieces:
            yield doc, start, ids, total, self.next_id, at
            at += len(ids)
        self.next_id += 1

    def flush(self) -> Iterator[tuple]:
        rest = [p for j in sorted(self.open) for p in self.open[j]]
        self.open.clear()
        left = sum(len(p[2]) for p in rest)
        at = 0
        while left:
            room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= room
            taken: list[Piece] = []
            while room:
                doc, start, ids, total = rest[at]
                part, more = ids[:room], ids[room:]
                taken.append((doc, start, part, total))
                room -= len(part)
                if len(more):
                    rest[at] = (doc, start + len(part), more, total)
                else:
                    at += 1
            yield from self.sequence(taken)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    grain: int = 64,
    separator: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, start, length, crc of its ids, tokens of its document, sequence and offset (and the ids)."""
    if capacity & (capacity - 1) or grain & (grain - 1) or not 1 <= grain <= capacity:
        raise ValueError("capacity and grain must be powers of two, grain the smaller")
    with open(tokenizer, "rb") as f:  # a file of the driver; fixed size
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(content.value)
        bins = Bins(capacity, grain, TaskContext.get().partitionId() << 40)
        arrow_id: list[pa.DataType] = []

        def table(found: list[tuple]) -> pa.RecordBatch:
            doc, start, ids, total, sequence, at = (list(x) for x in zip(*found, strict=True))
            columns = {
                "doc_id": pa.array(doc, arrow_id[0]), "start": pa.array(start, pa.int64()), "length": pa.array([len(x) for x in ids], pa.int64()), "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                "doc_tokens": pa.array(total, pa.int64()), "sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(at, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(columns)

        for batch in slices(batches, "text"):
            arrow_id[:] = [batch.schema.field("doc_id").type]
            found: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encode(text)
                ids.append(separator)
                found += bins.add(doc, np.asarray(ids, dtype="<u4"))
            if found:
                yield table(found)
        if rest := list(bins.flush()):
            yield table(rest)

    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, {COLUMNS}" + (", ids array<int>" if with_ids else ""))
