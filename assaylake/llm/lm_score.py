"""Cross-entropy difference: bigram models of a target and of all documents, over one vocabulary.

Words are runs of other bytes than ASCII white space, A-Z lower-cased. Both models count unigrams and
bigrams of whole texts. All words and bigrams of all documents have counts of their own, in a
distributed table that grows with the corpus; they are told apart by 63-bit hashes, and the highest bits
of a hash name its bucket. P(w|h) = weight * c(h,w) / c(h) + (1 - weight) * (c(w) + alpha) / (N + alpha * V);
the score of a document is the mean over its words of the target's loss less the background's loss, in
nats: the lower, the more like the target.

Counting: a task sums its texts' hashes and hands on, for each bucket, one sorted list of hashes with
their counts, so that no hash weighs on a task however often it occurs. Scoring: documents meet in
slices of about SLICE_TEXT bytes; a slice asks each bucket once for the hashes that are not among the
FREQUENT most frequent ones (which are broadcast), by their highest bits, and the answers, with whole
hashes, meet the slice's documents. With
`singles=False` the table leaves out what occurs once: in the documents that the model was fitted on,
anything not in the table is known to be such.

With `vocab_size` given, the model is a small one of fixed size instead: the most frequent words (ties
in byte order), one unknown word, and bigrams in 2^`bits` hash buckets.

Defined cases: null, empty and blank texts have no words and null losses and score; repeated rows
count and are scored each for itself; a null id is never a target; without target documents the
target model is uniform over the vocabulary; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.llm._common import quoted, raw_text, slices, written

#: Words and bigrams whose counts are broadcast at most (16 bytes each).
FREQUENT = 1 << 20
#: Bytes of text of a slice and of a bucket's share, and hashes that a task holds before it hands their counts on.
SLICE_TEXT, BUCKET_TEXT, HELD = 16 << 20, 16 << 20, 1 << 20
#: Bytes of text that are counted or scored at once.
WORKED = 4 << 20
#: In place of the context: of a text's first word, and of a unigram's count.
START, UNIGRAM = 1, 0
#: Distinct words that a task holds before it hands its counts on.
HELD_WORDS = 1 << 19
#: Levels of frequency for each doubling, and how many times the vocabulary may be candidates.
LEVELS, SLACK = 16, 8
#: Target ids that are broadcast at most; beyond, documents and targets meet in a shuffle.
MAX_BROADCAST_IDS = 4_000_000


@dataclass(frozen=True)
class Pair:
    """Both models: counts of unigrams (V+1, the last is unknown) and bucketed bigrams, as target and background."""

    words: dict[bytes, int]
    uni: np.ndarray  # 2 x (V + 1)
    start: np.ndarray  # documents with a first word, of each model
    bi: np.ndarray  # 2 x buckets
    weight: float
    alpha: float

    def ids(self, text: bytes | None) -> np.ndarray:
        return word_ids(self.words, text)

    def losses(self, ids: np.ndarray) -> np.ndarray:
        """2 x words: negative log probabilities."""
        own, before = buckets(ids, len(self.words), self.bi.shape[1])
        out = []
        for m in range(2):
            uni = self.uni[m]
            context = np.append(uni, self.start[m])[before]
            joint = np.minimum(np.minimum(self.bi[m][own], context), uni[ids])  # a bucket may hold other bigrams too
            plain = (uni[ids] + self.alpha) / (uni.sum() + self.alpha * len(uni))
            out.append(-np.log(np.where(context > 0, self.weight * joint / np.maximum(context, 1) + (1 - self.weight) * plain, plain)))
        return np.array(out)


def word_ids(words: dict[bytes, int], text: bytes | None) -> np.ndarray:
    unknown, get = len(words), words.get
    return np.array([get(w, unknown) for w in (text or b"").lower().split()], dtype=np.int64)


def buckets(ids: np.ndarray, vocab: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each bigram, its context); the first word's context is number vocab + 1."""
    before = np.empty_like(ids)
    before[:1] = vocab + 1
    before[1:] = ids[:-1]
    mixed = (before.astype(np.uint64) * np.uint64(vocab + 2) + ids.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - (n.bit_length() - 1))).astype(np.int64), before


@dataclass(frozen=True)
class Counts:
    """Both models over all words: a table (bucket, keys, t, b) of packed sorted hashes and their counts."""

    docs: DataFrame
    targets: DataFrame
    table: DataFrame
    bits: int  # 2^bits buckets
    words: int
    totals: tuple[int, int]  # words of the target's and of all texts
    held: int  # hashes in the table
    size: int  # bytes of all texts
    singles: bool
    weight: float
    alpha: float


def word_hashes(text: bytes | None) -> np.ndarray:
    words = (text or b"").lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def keys_of(before: np.ndarray | int, own: np.ndarray | int) -> np.ndarray:
    """Hashes of bigrams, even; with UNIGRAM in place of the context, of words and of first words, odd."""
    x = np.asarray(before, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = ((x ^ (x >> np.uint64(32))) + np.asarray(own, np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    x = x ^ (x >> np.uint64(32))
    return (x & ~np.uint64(1)) | np.uint64(np.ndim(before) == 0 and before == UNIGRAM)


#: Its count is the number of texts with a first word.
FIRST = keys_of(UNIGRAM, np.array([START]))[0]


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting: without counts np.unique fills a hash table, which takes many times the time and memory of the array."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


@dataclass(frozen=True)
class Texts:
    """Several texts: their numbers of words, and the hashes of all bigrams and of all words."""

    sizes: np.ndarray
    pairs: np.ndarray
    words: np.ndarray

    @staticmethod
    def of(texts: list[bytes | None]) -> Texts:
        found = [word_hashes(x) for x in texts]
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        own = np.concatenate([np.zeros(0, np.uint64), *found])
        before = np.concatenate((np.zeros(1, np.uint64), own))[: len(own)]
        before[np.concatenate(([0], np.cumsum(sizes)))[:-1][sizes > 0]] = START
        return Texts(sizes, keys_of(before, own), keys_of(UNIGRAM, own))

    def asked(self) -> np.ndarray:
        return distinct(np.concatenate((self.pairs, self.words, np.repeat(FIRST, int((self.sizes > 0).any())))))


def packed(x: np.ndarray) -> bytes:
    """An array's bytes, those of equal place side by side, compressed."""
    return zstandard.compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes(), 1)


def unpacked(raw: bytes | pa.Buffer, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(width, -1).T.copy().view(kind).reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(raw: bytes | pa.Buffer) -> np.ndarray:
    return np.cumsum(unpacked(raw, np.uint64), dtype=np.uint64)


def by_bucket(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Buckets of sorted keys."""
    if not len(keys):
        return
    own = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edges = np.flatnonzero(np.diff(own, prepend=-1))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(keys)], strict=True):
        yield int(own[a]), slice(a, b)


def summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(keys, t, b) of sorted distinct keys from several such."""
    first, *counts = zip(*parts, strict=True)
    keys = np.concatenate(first)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(np.concatenate(c)[order], first) if len(first) else np.concatenate(c) for c in counts)  # one column at a time


def tallied(marked: DataFrame, bits: int) -> DataFrame:
    """(bucket, keys, t, b) counts of parts of (text, target)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def told() -> pa.RecordBatch:
            keys, t, b = summed(held)
            held.clear()
            rows = [(k, packed_keys(keys[x]), packed(t[x]), packed(b[x])) for k, x in by_bucket(keys, bits)]
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "keys", "t", "b"])

        for batch in slices(batches, "text", WORKED):
            texts = Texts.of(batch.column("text").to_pylist())
            target = np.array(batch.column("target").to_pylist(), dtype=bool)
            some = texts.sizes > 0
            if not some.any():
                continue
            wanted = np.repeat(target, texts.sizes)
            keys, n = np.unique(np.concatenate((texts.pairs, texts.words)), return_counts=True)
            aim, m = np.unique(np.concatenate((texts.pairs[wanted], texts.words[wanted])), return_counts=True)
            t = np.zeros(len(keys), np.int64)
            t[np.searchsorted(keys, aim)] = m
            held += [(keys, t, n.astype(np.int64)), (np.array([FIRST]), np.array([(some & target).sum()]), np.array([some.sum()]))]
            if sum(len(x[0]) for x in held) > HELD:
                yield told()
        if held:
            yield told()

    return marked.mapInArrow(run, "bucket int, keys binary, t binary, b binary")


def keyed(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """The rows of batches, and None when the first of the columns changes and at the end."""
    last = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if last is not None and row[0] != last:
                yield None
            last = row[0]
            yield row
    if last is not None:
        yield None


def merged(tallies: DataFrame, singles: bool) -> DataFrame:
    """One row of each bucket, with its numbers of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for row in keyed(batches, "bucket", "keys", "t", "b"):
            if row is not None:
                bucket = row[0]
                held.append((unpacked_keys(row[1]), unpacked(row[2], np.int64), unpacked(row[3], np.int64)))
                if len(held) >= 64:
                    held = [summed(held)]
                continue
            keys, t, b = summed(held)
            held = []
            words = ((keys & np.uint64(1)) == 1) & (keys != FIRST)
            numbers = [int(words.sum()), int(t[words].sum()), int(b[words].sum())]
            if not singles:
                keys, t, b = keys[b > 1], t[b > 1], b[b > 1]
            own = (packed_keys(keys), packed(t), packed(b)) if len(keys) else (None, None, None)
            kinds = (pa.int32(), *[pa.binary()] * 3, *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip((bucket, *own, len(keys), *numbers), kinds, strict=True)], names=["bucket", "keys", "t", "b", "held", "words", "nt", "nb"])

    return tallies.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "bucket int, keys binary, t binary, b binary, held long, words long, nt long, nb long")


def frequent(table: DataFrame) -> tuple[np.ndarray, ...]:
    """(keys, t, b) of the FREQUENT most frequent keys at most: whole levels of frequency."""

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("b").to_pylist():
                level, n = np.unique(np.floor(np.log2(unpacked(raw, np.int64)) * LEVELS).astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_pydict({"level": pa.array(level), "n": pa.array(n.astype(np.int64))})

    rows = table.where("keys IS NOT NULL")
    sizes = {r["level"]: r["n"] for r in rows.select("b").mapInArrow(levels, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()}  # 64 * LEVELS at most
    held, least = 0, 1 << 30
    for level in sorted(sizes, reverse=True):
        held += sizes[level]
        if held > FREQUENT:
            break
        least = level

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in zip(*(batch.column(c).to_pylist() for c in ("keys", "t", "b")), strict=True):
                keys, t, b = unpacked_keys(raw[0]), unpacked(raw[1], np.int64), unpacked(raw[2], np.int64)
                own = np.floor(np.log2(b) * LEVELS) >= least
                yield pa.RecordBatch.from_pydict({"k": pa.array(keys[own].view(np.int64)), "t": pa.array(t[own]), "b": pa.array(b[own])})

    got = rows.select("keys", "t", "b").mapInArrow(chosen, "k long, t long, b long").toArrow()  # FREQUENT rows at most
    keys, t, b = (got[c].to_numpy() for c in ("k", "t", "b"))
    order = np.argsort(keys.view(np.uint64))
    return keys.view(np.uint64)[order], t[order], b[order]


def places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted among sorted keys, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def with_heads(heads: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Places of the asked (sorted, distinct) among sorted heads that may repeat; the work grows with the asked and not with all heads."""
    first = np.searchsorted(heads, asked)
    n = np.searchsorted(heads, asked, "right") - first
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def laid(rows: pa.StructArray | None) -> tuple[np.ndarray, ...]:
    """(keys, t, b) of a slice's answers, sorted. A bucket answers once and buckets share no key, so the answers are unpacked one behind the other, each into its place."""
    n = np.zeros(0, np.int64) if rows is None else rows.field("n").to_numpy()
    out = np.empty(n.sum(), np.uint64), np.empty(n.sum(), np.int64), np.empty(n.sum(), np.int64)
    at = 0
    for i in np.argsort(rows.field("bucket").to_numpy()).tolist() if len(n) else ():
        to = at + int(n[i])
        out[0][at:to] = unpacked_keys(rows.field("keys")[i].as_buffer())
        for counts, name in zip(out[1:], ("t", "b"), strict=True):
            counts[at:to] = unpacked(rows.field(name)[i].as_buffer(), np.int64)
        at = to
    return out


def vocabulary(rows: DataFrame, size: int) -> dict[bytes, int]:
    """The `size` most frequent words by rank. Levels of frequency tell which words can be among them, so at most SLACK * size words go to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return out

        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                seen.update((text or b"").lower().split())
            if len(seen) > HELD_WORDS:
                yield told()
        if seen:
            yield told()

    level = F.floor(F.log2("n") * LEVELS).cast("int")
    counts = written(rows.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).withColumn("level", level))
    sizes = {r["level"]: r["words"] for r in counts.groupBy("level").agg(F.count(F.lit(1)).alias("words")).collect()}  # 64 * LEVELS at most
    above, least = 0, 0
    for least in sorted(sizes, reverse=True):
        above += sizes[least]
        if above >= size:
            break
    able = counts.where(F.col("level") >= least)
    if above > SLACK * size:  # many words as rare as the last one: the first of each of a few groups, still all that can be among the first
        order = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(SLACK))).orderBy(F.desc("n"), "word")
        able = able.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    got = able.orderBy(F.desc("n"), "word").limit(size).select("word").collect()
    return {bytes(r["word"]): i for i, r in enumerate(got)}


def mark(rows: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """The columns, and whether the row's id is wanted."""
    few = wanted.count() <= MAX_BROADCAST_IDS
    return rows.join(F.broadcast(wanted) if few else wanted, "id", "left").select(*columns, F.coalesce("target", F.lit(False)).alias("target"))


def fit(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab_size: int | None = None, bits: int = 20, weight: float = 0.6, alpha: float = 0.1, singles: bool = True) -> Counts | Pair:
    """Both models; `targets` holds the ids of the target documents in its column `id_col`. Without `singles` the model can only score `docs` themselves."""
    spark = docs.sparkSession
    rows = docs.select(F.col(quoted(id_col)).alias("id"), raw_text(quoted(text_col)).alias("text"))
    wanted = targets.select(F.col(quoted(id_col)).alias("id")).where("id IS NOT NULL").distinct().withColumn("target", F.lit(True))
    marked = mark(rows, wanted, "text")

    if vocab_size is None:
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
        own = max(0, math.ceil(math.log2(max(1, size) / BUCKET_TEXT)))
        table = written(merged(tallied(marked, own), singles))
        n = table.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("held", "words", "nt", "nb")]).first()
        return Counts(docs, wanted, table, own, n["words"], (n["nt"], n["nb"]), n["held"], size, singles, weight, alpha)
    words = vocabulary(rows, vocab_size)
    v, n = len(words) + 1, 1 << bits
    shared = spark.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        sums = np.zeros((2, n + v + 1), dtype=np.int64)  # bigram buckets, unigrams, first words
        for batch in slices(batches, "text"):
            for text, target in zip(batch.column("text").to_pylist(), batch.column("target").to_pylist(), strict=True):
                ids = word_ids(words, text)
                if not len(ids):
                    continue
                own, _ = buckets(ids, len(words), n)
                at = np.concatenate((own, n + ids, [n + v]))
                at, times = np.unique(at, return_counts=True)
                sums[1, at] += times
                if target:
                    sums[0, at] += times
        used = np.flatnonzero(sums[1])
        for a in range(0, len(used), 1 << 17):
            own = used[a : a + (1 << 17)]
            yield pa.RecordBatch.from_pydict({"at": pa.array(own.astype(np.int32)), "t": pa.array(sums[0, own]), "b": pa.array(sums[1, own])})

    got = marked.mapInArrow(count, "at int, t long, b long").groupBy("at").agg(F.sum("t").alias("t"), F.sum("b").alias("b")).toArrow()  # 2^bits + V + 2 rows at most, as columns
    sums = np.zeros((2, n + v + 1), dtype=np.float64)
    at = got["at"].to_numpy()
    sums[0, at], sums[1, at] = got["t"].to_numpy(), got["b"].to_numpy()
    return Pair(words, sums[:, n : n + v], sums[:, n + v], sums[:, :n].astype(np.float32), weight, alpha)


def score_all(docs: DataFrame, model: Counts, id_col: str, text_col: str) -> DataFrame:
    """The scores by the distributed counts."""
    if not model.singles and not docs.sameSemantics(model.docs):
        raise ValueError("a model without singles can only score the documents that it was fitted on")
    spark = docs.sparkSession
    rows = docs.select(F.col(quoted(id_col)).alias("id"), raw_text(quoted(text_col)).alias("text"))
    n = max(1, -(-model.size // SLICE_TEXT))
    kind = rows.schema["id"].dataType
    marked = mark(rows, model.targets, "id", "text", F.pmod(F.xxhash64("id", "text"), F.lit(n)).alias("slice"), F.lit(False).alias("opens"))
    opening = spark.range(n).select(F.lit(None).cast(kind).alias("id"), F.lit(None).cast("binary").alias("text"), F.col("id").alias("slice"), F.lit(True).alias("opens"), F.lit(False).alias("target"))
    # Both uses below have the same columns, so that the texts are shuffled once (with another number of partitions the join shuffles them again).
    dealt = marked.unionByName(opening).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "slice")
    shared = spark.sparkContext.broadcast(frequent(model.table))
    bits, singles, weight, alpha = model.bits, model.singles, model.weight, model.alpha
    plain_total = [x + alpha * (model.words + 1) for x in model.totals]
    #: An ask names a key by its highest bits only: few enough for one byte or two, enough for about one wrong answer in 64.
    short = np.uint64(64 - min(64, max(bits, model.held.bit_length() + 6)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(bucket, slice, heads) of the keys that a slice needs to know."""
        own: list[np.ndarray] = []

        def told(name: int) -> Iterator[pa.RecordBatch]:
            if own:
                for bucket, x in by_bucket(keys := distinct(np.concatenate(own)), bits):
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "slice": pa.array([name], pa.int64()), "keys": pa.array([packed_keys(distinct(keys[x] >> short))], pa.binary())})
                own.clear()

        name = None
        for batch in slices(batches, "text", WORKED):
            column = batch.column("slice").to_numpy()
            edges = np.flatnonzero(np.diff(column, prepend=-1)).tolist()
            for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
                if name is not None and column[a] != name:
                    yield from told(name)
                name = int(column[a])
                wanted = Texts.of(batch.column("text").slice(a, b - a).to_pylist()).asked()
                own.append(wanted[~places(shared.value[0], wanted)[1]])
                if len(own) >= 16:
                    own[:] = [distinct(np.concatenate(own))]
        if name is not None:
            yield from told(name)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(slice, bucket, n, keys, t, b) of a bucket's keys with the asked heads; the bucket's own row comes first."""
        known = heads = None
        for row in keyed(batches, "bucket", "slice", "keys", "t", "b"):
            if row is None:
                known = heads = None
            elif row[1] is None:
                if row[2] is not None:
                    known = (unpacked_keys(row[2]), unpacked(row[3], np.int64), unpacked(row[4], np.int64))
                    heads = known[0] >> short
            elif known is not None:
                hit = with_heads(heads, unpacked_keys(row[2]))
                if len(hit):
                    yield pa.RecordBatch.from_pydict({"slice": pa.array([row[1]], pa.int64()), "bucket": pa.array([row[0]], pa.int32()), "n": pa.array([len(hit)], pa.int64()), "keys": pa.array([packed_keys(known[0][hit])], pa.binary()), "t": pa.array([packed(known[1][hit])], pa.binary()), "b": pa.array([packed(known[2][hit])], pa.binary())})

    nothing = F.lit(None).cast("binary")
    asked = dealt.sortWithinPartitions("slice").mapInArrow(ask, "bucket int, slice long, keys binary")
    met = model.table.select("bucket", F.lit(None).cast("long").alias("slice"), "keys", "t", "b").unionByName(asked.select("bucket", "slice", "keys", nothing.alias("t"), nothing.alias("b")))
    answers = met.repartition("bucket").sortWithinPartitions("bucket", F.asc_nulls_first("slice")).mapInArrow(answer, "slice long, bucket int, n long, keys binary, t binary, b binary")
    told = answers.groupBy(F.col("slice").alias("asker")).agg(F.collect_list(F.struct("bucket", "n", "keys", "t", "b")).alias("told"))
    names = [id_col, "n_tokens", "target_loss", "background_loss", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None

        def counts(keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Both models' counts of keys."""
            t, b = (np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)) if singles else (flags.astype(np.int64), np.ones(len(keys), np.int64))
            order = np.argsort(keys)  # a search in order stays near the last place
            for own in (shared.value, known):
                at, hit = places(own[0], keys[order])
                t[order[hit]], b[order[hit]] = own[1][at[hit]], own[2][at[hit]]
            return t, b

        for batch in slices(batches, "text", WORKED):
            opens = np.flatnonzero(batch.column("opens").to_numpy(zero_copy_only=False)).tolist()
            for a, b in zip([-1, *opens], [*opens, batch.num_rows], strict=True):
                if a >= 0:  # the first row of a slice
                    known = None  # before the next slice's is made
                    known = laid(batch.column("told")[a].values)
                part = batch.slice(a + 1, b - a - 1)
                if not part.num_rows:
                    continue
                texts = Texts.of(part.column("text").to_pylist())
                flags = np.repeat(np.array(part.column("target").to_pylist(), dtype=bool), texts.sizes)
                pair, word = counts(texts.pairs, flags), counts(texts.words, flags)
                first = counts(np.array([FIRST]), np.zeros(1, bool))
                some = np.flatnonzero(texts.sizes)
                starts = np.concatenate(([0], np.cumsum(texts.sizes)))[:-1][some]
                means = []
                for m in range(2):
                    context = np.concatenate((first[m], word[m]))[: len(word[m])]
                    context[starts] = first[m][0]
                    plain = (word[m] + alpha) / plain_total[m]
                    loss = -np.log(np.where(context > 0, weight * pair[m] / np.maximum(context, 1) + (1 - weight) * plain, plain))
                    mean = np.full(len(texts.sizes), np.nan)
                    if len(some):
                        mean[some] = np.add.reduceat(loss, starts) / texts.sizes[some]
                    means.append(mean)
                none = texts.sizes == 0
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts.sizes), *(pa.array(x, pa.float64(), mask=none) for x in (means[0], means[1], means[0] - means[1]))], names=names)

    double = T.DoubleType()
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_tokens", T.LongType()), *(T.StructField(c, double) for c in names[2:])])
    joined = dealt.join(told.hint("merge"), (dealt["slice"] == told["asker"]) & dealt["opens"], "left").drop("asker")
    return joined.sortWithinPartitions("slice", F.desc("opens")).mapInArrow(run, schema)


def score(docs: DataFrame, model: Counts | Pair, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, target_loss, background_loss and score of every row."""
    if isinstance(model, Counts):
        return score_all(docs, model, id_col, text_col)
    rows = docs.select(F.col(quoted(id_col)).alias(id_col), raw_text(quoted(text_col)).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [id_col, "n_tokens", "target_loss", "background_loss", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, "text"):
            ids = [own.ids(x) for x in batch.column("text").to_pylist()]
            means = [own.losses(x).mean(axis=1).tolist() if len(x) else [None, None] for x in ids]
            yield pa.RecordBatch.from_arrays([
                batch.column(id_col), pa.array([len(x) for x in ids], pa.int64()), pa.array([m[0] for m in means], pa.float64()), pa.array([m[1] for m in means], pa.float64()),
                pa.array([None if m[0] is None else m[0] - m[1] for m in means], pa.float64()),
            ], names=names)

    double = T.DoubleType()
    return rows.mapInArrow(run, T.StructType([T.StructField(id_col, rows.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), *(T.StructField(c, double) for c in names[2:])]))
