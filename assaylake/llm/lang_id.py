"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fit: documents are drawn by a hash of their id until about `max_docs_per_lang` of each language are
used (a documented bound of the labelled sample); n-gram counts are summed by Spark as (language,
bucket, count) rows and become one log-probability matrix of `buckets` x languages float32, whose
size is checked before it is broadcast. Scoring reads whole texts, many at a time: a batch of about
`PIECE` code points gathers the matrix rows of all its n-grams and sums them by text; longer texts are
read in pieces of that length.

Defined cases: null text or text without a letter gives `und` with score 0; no labelled row gives
`und` for all; repeated rows are predicted alike; equal scores go to the language first in
alphabetical order; a null id is never held out; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.llm._common import quoted, slices

PIECE = 1 << 18
MAX_MODEL_BYTES = 256 << 20
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter or a mark."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), dtype=bool, count=0x110000)


def letter_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts in one array, and where each text ends in it.

    Every run of other characters than letters and marks is one space, also at both ends of a text.
    """
    lower = [x.lower() for x in texts]
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where(letters()[codes], codes, 32).astype(np.uint32)
    ends = np.cumsum([len(x) for x in lower])
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    codes = np.insert(codes, np.stack((starts, ends), axis=1).reshape(-1), np.uint32(32))
    ends = ends + 2 * np.arange(1, len(texts) + 1)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    keep[ends[:-1]] = True  # the first space of the next text
    return codes[keep], np.cumsum(keep)[ends - 1]


def gram_buckets(codes: np.ndarray, left: np.ndarray, orders: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the places at which an n-gram begins, and its bucket; `left` is the number of code points from a place to its text's end."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    h = np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, max(orders) + 1):
        h = (h[: len(codes) - n + 1] * np.uint32(0x01000193)) ^ (codes[n - 1 :] * np.uint32(0x9E3779B1))
        if n in orders and len(h):
            at = np.flatnonzero(left[: len(h)] >= n)
            yield at, ((h[at] ^ np.uint32(n)) * np.uint32(0x85EBCA6B)) >> shift


def grams(texts: list[str], orders: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, bucket) of all n-grams, PIECE code points at a time; pieces overlap so that no n-gram is lost."""
    if not texts:
        return
    codes, ends = letter_codes(texts)
    longest = max(orders)
    sizes = np.diff(ends, prepend=0)
    text = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(codes))
    left[sizes[text] < 3] = 0  # nothing but a space
    for at in range(0, len(codes), PIECE):
        own = slice(at, at + PIECE + longest - 1)
        for places, found in gram_buckets(codes[own], left[own], orders, buckets):
            first = np.searchsorted(places, PIECE)
            yield text[at + places[:first]], found[:first]


def batches_of(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about PIECE code points, one text at least."""
    held: list[str | None] = []
    size = 0
    for x in texts:
        held.append(x)
        size += len(x or "")
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass(frozen=True)
class LangModel:
    langs: tuple[str, ...]
    log_prob: np.ndarray  # buckets x languages
    log_prior: np.ndarray
    orders: tuple[int, ...]

    @property
    def nbytes(self) -> int:
        return self.log_prob.nbytes

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its posterior probability of each text: rows of the matrix for all n-grams of a batch at once, summed by text."""
        able = [i for i, x in enumerate(texts) if x and self.langs and any(map(str.isalpha, x))]
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        total = np.tile(self.log_prior, (len(able), 1))
        for text, found in grams([texts[i] for i in able], self.orders, len(self.log_prob)):
            starts = np.flatnonzero(np.diff(text, prepend=-1))
            if len(starts):
                total[text[starts]] += np.add.reduceat(self.log_prob[found], starts, axis=0, dtype=np.float64)
        for i, row in zip(able, total, strict=True):
            best = int(np.argmax(row))
            langs[i], scores[i] = self.langs[best], float(1.0 / np.exp(row - row[best]).sum())
        return langs, scores


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    where: Column | None = None,
    max_docs_per_lang: int = 4000,
    buckets: int = 1 << 15,
    orders: tuple[int, ...] = (1, 2, 3, 4),
    alpha: float = 0.1,
) -> LangModel:
    """Counts of a bounded labelled sample as a model; `where` tells which rows may be learned from."""
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"), F.col(quoted(lang_col)).alias("lang"), (where if where is not None else F.lit(True)).alias("may"))
    rows = rows.where("may AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = tuple(sorted(sizes))
    if 4 * buckets * len(langs) > MAX_MODEL_BYTES:
        raise ValueError(f"{len(langs)} languages x {buckets} buckets exceed the broadcast bound of {MAX_MODEL_BYTES} bytes")
    if not langs:
        return LangModel((), np.zeros((buckets, 0), np.float32), np.zeros(0), orders)
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, max_docs_per_lang / n)))])
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("lang"), "id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                own = sums.setdefault(lang, np.zeros(buckets, dtype=np.int64))
                for few in batches_of(texts):
                    for _, found in grams(few, orders, buckets):
                        own += np.bincount(found, minlength=buckets)
        for lang, own in sums.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(used), pa.string()), "bucket": pa.array(used.astype(np.int32)), "n": pa.array(own[used])})

    got = drawn.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((buckets, len(langs)), dtype=np.float64)
    counts[got["bucket"].to_numpy(dtype=np.int64), got["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.float64)
    log_prob = np.log(counts + alpha) - np.log(counts.sum(axis=0) + alpha * buckets)
    prior = np.array([sizes[k] for k in langs], dtype=np.float64)
    return LangModel(langs, log_prob.astype(np.float32), np.log(prior / prior.sum()), orders)


def predict(docs: DataFrame, model: LangModel, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """`docs` with the predicted language and its posterior; columns of these names are replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    base = docs.drop(pred_col, score_col)
    names = base.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, text_col):
            langs: list[str] = []
            scores: list[float] = []
            for few in batches_of(batch.column(text_col).to_pylist()):
                more = own.predict(few)
                langs += more[0]
                scores += more[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, pred_col, score_col])

    schema = T.StructType([*base.schema.fields, T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    return base.mapInArrow(score, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the third of the ids that is never learned from."""
    return F.coalesce(F.crc32(F.col(quoted(id_col)).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fit_options) -> DataFrame:
    """id, held_out, lang_pred, score for every row; learned from the rows that are not held out."""
    model = fit(docs, text_col, lang_col, id_col, where=~held_out(id_col), **fit_options)
    rows = docs.select(F.col(quoted(id_col)).alias(id_col), held_out(id_col).alias("held_out"), F.col(quoted(text_col)).alias("text"))
    return predict(rows, model, "text").drop("text")
