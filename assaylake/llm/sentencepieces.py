"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a single-pass Viterbi search.

The automaton is built over all pieces of a model; while it reads a text once, its output links give
at each position every piece that ends there, longest first, and each at once relaxes the best score
of that position. A character that no piece covers alone costs the smallest score less ten and falls back to
its bytes, or to the unknown id where the model has no byte pieces. The result is the best-scoring
segmentation under the model's piece scores: what unigram models define; models whose scores are
merge ranks get the segmentation of the best rank sum, which can differ from merging.

Best paths never cross a boundary that no piece spans (before white space after other characters, at
line breaks and tabs that no piece holds), so a text is searched unit by unit and the units of a
worker are remembered in a bounded table. Texts are whole; the memory is that of one unit's search.

Defined cases: null and empty texts have no ids and decode to an empty text; the escape character
U+2581 of a text counts as a space, as in the library, so such texts come back with spaces and have
round_trip false; repeated rows are encoded
alike; a null id stays null; an empty table gives no rows; other columns are ignored. Only models
with the identity normaliser are taken; others are an error.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.llm._common import quoted, slices

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 300_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Pieces:
    """A model's pieces, its automaton and its two directions."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        norm = spec.normalizer_spec
        if norm.name != "identity" or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only the identity normaliser with escaped white space is supported")
        self.prefix = norm.add_dummy_prefix
        self.pieces = [p.piece for p in spec.pieces]
        self.kinds = [p.type for p in spec.pieces]
        self.unknown = self.kinds.index(UNKNOWN)
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.automaton, self.single = ahocorasick.Automaton(), set()
        scores = [p.score for p in spec.pieces if p.type == NORMAL]
        self.unknown_score = min(scores, default=0.0) - UNKNOWN_PENALTY
        top, spans = max(scores, default=0.0), set()
        for i, p in enumerate(spec.pieces):
            if p.type in (NORMAL, USER):
                score = p.score if p.type == NORMAL else len(p.piece) * top - 0.1
                self.automaton.add_word(p.piece, (len(p.piece), score, i))
                if len(p.piece) == 1:
                    self.single.add(p.piece)
                spans |= {c for c in (SPACE, "\n", "\t") if c in (p.piece.lstrip(SPACE) if c == SPACE else p.piece)}
        if len(self.automaton):
            self.automaton.make_automaton()
        hard = "".join(c for c in "\n\t" if c not in spans)
        self.unit = re.compile(rf"[{hard}]|{SPACE}*[^{SPACE}{hard}]+|{SPACE}+" if hard else rf"{SPACE}*[^{SPACE}]+|{SPACE}+") if SPACE not in spans else re.compile(r"(?s).+")
        self.written = [self._written(i) for i in range(len(self.pieces))]
        self.memory: dict[str, bytes] = {}

    def _written(self, i: int) -> str | None:
        return None if self.kinds[i] == BYTE else "" if self.kinds[i] == CONTROL else " ⁇ " if self.kinds[i] == UNKNOWN else self.pieces[i].replace(SPACE, " ")

    def viterbi(self, unit: str) -> list[int]:
        """Ids of the best path through one unit."""
        n, single, unknown = len(unit), self.single, self.unknown_score
        best, back = [0.0] + [-float("inf")] * n, [(1, -1)] * (n + 1)
        done = 0  # positions up to here have their final score
        for end, (length, score, i) in self.automaton.iter(unit) if len(self.automaton) else ():
            while done < end:
                done += 1
                if unit[done - 1] not in single and best[done - 1] + unknown > best[done]:
                    best[done], back[done] = best[done - 1] + unknown, (1, -1)
            reached = best[end + 1 - length] + score
            if reached > best[end + 1]:
                best[end + 1], back[end + 1] = reached, (length, i)
        while done < n:
            done += 1
            if unit[done - 1] not in single and best[done - 1] + unknown > best[done]:
                best[done], back[done] = best[done - 1] + unknown, (1, -1)
        out: list[int] = []
        at = n
        while at:
            length, i = back[at]
            if i < 0:
                raw = unit[at - 1].encode("utf-8", "replace")
                out += [self.byte_ids[b] for b in reversed(raw)] if self.byte_ids else [self.unknown]
            else:
                out.append(i)
            at -= length
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text as little-endian unsigned 32-bit numbers."""
        if not text:
            return np.zeros(0, dtype="<u4")
        line = (SPACE if self.prefix else "") + text.replace(" ", SPACE)
        memory, parts = self.memory, []
        for unit in self.unit.findall(line):
            own = memory.get(unit)
            if own is None:
                own = np.array(self.viterbi(unit), dtype="<u4").tobytes()
                if len(unit) <= 64:
                    if len(memory) >= REMEMBERED:
                        memory.clear()
                    memory[unit] = own
            parts.append(own)
        return np.frombuffer(b"".join(parts), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        parts = [self.written[i] for i in ids.tolist()]
        if None in parts:
            joined, raw = [], bytearray()
            for i, part in zip(ids.tolist(), parts, strict=True):
                if part is None:
                    raw.append(self.byte_of[i])
                    continue
                if raw:
                    joined.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                joined.append(part)
            if raw:
                joined.append(raw.decode("utf-8", "replace"))
            parts = joined
        text = "".join(parts)
        return text[1:] if self.prefix and text[:1] == " " else text


@lru_cache(maxsize=2)
def pieces(model: bytes) -> Pieces:
    return Pieces(model)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_crc32, n_bytes (ids of single bytes), round_trip (the ids decode to the text), and the ids if wanted."""
    with open(model, "rb") as f:  # a file of the driver; fixed size
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(quoted(id_col)).alias(id_col), F.col(quoted(text_col)).alias("text"))
    names = [id_col, "n_tokens", "ids_crc32", "n_bytes", "round_trip"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(content.value)
        is_byte = np.array([k == BYTE for k in own.kinds])
        for batch in slices(batches, "text"):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            found = [own.encode(x) for x in texts]
            columns = [
                batch.column(id_col), pa.array([len(x) for x in found], pa.int64()), pa.array([zlib.crc32(x) for x in found], pa.int64()), pa.array([int(is_byte[x].sum()) for x in found], pa.int64()),
                pa.array([own.decode(x) == t for x, t in zip(found, texts, strict=True)]),
            ]
            yield pa.RecordBatch.from_arrays(columns + [pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))] * with_ids, names=names)

    long = T.LongType()
    fields = [T.StructField(id_col, rows.schema[id_col].dataType), *(T.StructField(c, long) for c in names[1:4]), T.StructField("round_trip", T.BooleanType())]
    return rows.mapInArrow(run, T.StructType(fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids))


def decode(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """`rows` with the text of their ids; a null list gives an empty text; a column of that name is replaced."""
    with open(model, "rb") as f:
        content = rows.sparkSession.sparkContext.broadcast(f.read())
    base = rows.drop(text_col) if text_col != ids_col else rows
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(content.value)
        for batch in slices(batches):
            texts = [own.decode(np.array(x or [], dtype=np.int64)) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, text_col])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(text_col, T.StringType())]))
