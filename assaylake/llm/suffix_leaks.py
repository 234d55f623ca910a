"""Benchmark decontamination over suffix arrays of the training words.

Tasks cut their documents into shards of bounded size and sort all word suffixes of a shard, as deep as
the longest benchmark item, by prefix doubling: only groups of suffixes that are still equal are sorted
again. Every suffix of every item is then searched in the array, all at once and word by word, each
step narrowing its range by two binary searches. The range at a window's length holds all its occurrences; the
last range that is not empty is the suffix's longest verbatim match with its places. Words are compared as 64-bit
hashes and every found window again as text, so a hash decides nothing. Shards need no exchange: a document's
result comes from its own task, and a document larger than a shard goes through it piece by piece, the pieces
overlapping by an item's length.

The benchmark goes out to the tasks in blocks of `MAX_BENCHMARK_BYTES`; more than one block means that the documents
are read once for each, and the spans that the blocks find are put together by row.

Words are runs of digits, letters and all characters beyond ASCII, with A-Z lower-cased. A window is `window`
consecutive words of an item; an item with fewer words, but not none, is one window.

Defined cases: a null text has no words; an item with a null id, a null text or no words has no windows; items
that repeat an id are one item with the windows of all; repeated document rows, and rows with a null id, have their
own results; empty tables give no rows (documents) or find nothing (benchmark); other columns pass through,
but for those named n_words, spans and item_ids, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.llm._common import quoted, written

SHARD_BYTES = 4 << 20
MAX_BENCHMARK_BYTES = 32 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
SPANS = "array<struct<start:int,end:int>>"


def lowered_table() -> np.ndarray:
    """For each byte the lower-cased byte of a word, or 0 between words."""
    b = np.arange(256)
    b[65:91] += 32
    word = (b >= 48) & (b <= 57) | (b >= 97) & (b <= 122) | (b >= 128)
    return np.where(word, b, 0).astype(np.uint8)


LOWERED = lowered_table()


class Words:
    """The words of a text: their places and hashes."""

    def __init__(self, text: bytes):
        low = LOWERED[np.frombuffer(text, dtype=np.uint8)]
        inside = np.flatnonzero(low)
        first = np.ones(len(inside), dtype=bool)
        first[1:] = np.diff(inside) > 1
        at = np.flatnonzero(first)
        self.low, self.start = low, inside[at]
        size = np.diff(np.append(at, len(inside)))
        self.end = self.start + size
        self.key = np.zeros(0, dtype=np.uint64)
        if len(at):
            power = np.full(int(size.max()), BASE, dtype=np.uint64)
            power = np.multiply.accumulate(power)
            place = np.arange(len(inside), dtype=np.int32) - np.repeat(at.astype(np.int32), size)
            key = np.add.reduceat(power[place] * low[inside], at)
            self.key = np.maximum(key ^ (key >> np.uint64(29)), np.uint64(1))  # 0 stands between texts

    def text_of(self, a: int, b: int) -> bytes:
        """Words a to b as they compare."""
        return self.low[self.start[a] : self.end[b - 1]].tobytes()


def plain(raw: bytes) -> tuple[bytes, ...]:
    return tuple(w for w in raw.split(b"\0") if w)


class Tests:
    """All suffixes of the benchmark's items, and their windows."""

    def __init__(self, ids: list[str], texts: list[bytes], window: int):
        words = Words(b"\n".join(texts))
        lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), lengths)[words.start] if texts else np.zeros(0, dtype=np.int64)
        n = len(words.key)
        edge = np.searchsorted(owner, np.arange(len(texts) + 1))
        self.ids, self.owner, self.item_start = ids, owner, np.arange(n) - edge[owner]
        self.key, self.left = words.key, edge[owner + 1] - np.arange(n)
        self.depth = int(self.left.max(initial=1))
        whole = np.where(edge[owner + 1] - edge[owner] < window, self.item_start == 0, self.left >= window)
        #: Words of the window that starts here, 0 for none.
        self.window = np.where(whole, np.minimum(self.left, window), 0)
        spelled: dict[tuple[bytes, ...], int] = {}
        self.code = np.full(n, -1)
        items: list[set[str]] = []
        for p in np.flatnonzero(self.window).tolist():
            c = spelled.setdefault(plain(words.text_of(p, p + int(self.window[p]))), len(spelled))
            if c == len(items):
                items.append(set())
            items[c].add(ids[owner[p]])
            self.code[p] = c
        self.spelled, self.items = list(spelled), items
        self.suffixes = self.distinct()

    def distinct(self) -> np.ndarray:
        """One start of each different window; the other suffixes are needed for longest matches only."""
        starts = np.flatnonzero(self.window)
        return starts[np.unique(self.code[starts], return_index=True)[1]]


class Shard:
    """Suffix array of some word hashes; 0 separates texts."""

    def __init__(self, keys: np.ndarray, depth: int):
        n = len(keys)
        self.n, self.keys = n, np.concatenate((keys, np.zeros(depth + 1, dtype=np.uint64)))
        order = np.argsort(keys).astype(np.int32)
        rank = np.zeros(n + 1, dtype=np.int64)  # the end sorts before all
        firsts = np.ones(n, dtype=bool)
        firsts[1:] = keys[order[1:]] != keys[order[:-1]]
        rank[order] = np.flatnonzero(firsts)[np.cumsum(firsts) - 1] + 1
        k = 1
        while k < depth:
            lone = firsts & np.append(firsts[1:], True)
            open_ = np.flatnonzero(~lone)
            if not len(open_):
                break
            own = order[open_]
            both = rank[own] * (n + 1) + rank[np.minimum(own + k, n)]
            by = np.argsort(both)
            both, own = both[by], own[by]
            order[open_] = own
            split = np.ones(len(own), dtype=bool)
            split[1:] = both[1:] != both[:-1]
            firsts[open_] |= split
            rank[own] = open_[np.flatnonzero(split)[np.cumsum(split) - 1]] + 1
            k *= 2
        self.order = order

    def bound(self, low: np.ndarray, high: np.ndarray, key: np.ndarray, d: int, right: bool) -> np.ndarray:
        """For ranges that share d words, where word d of a suffix reaches (or passes) the key."""
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) >> 1
            there = self.keys[self.order[mid] + d]
            up = there <= key[open_] if right else there < key[open_]
            low[open_[up]] = mid[up] + 1
            high[open_[~up]] = mid[~up]
        return low

    def ranges(self, tests: Tests, suffixes: np.ndarray, longest: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each depth: (depth, suffixes with that many matching words, range starts and ends, whether their search ends here)."""
        low, high = np.zeros(len(suffixes), dtype=np.int64), np.full(len(suffixes), self.n)
        d = 0
        while len(suffixes):
            key = tests.key[suffixes + d]
            new_low = self.bound(low, high, key, d, right=False)
            new_high = self.bound(new_low, high, key, d, right=True)
            there = new_low < new_high
            if longest and d:
                yield d, suffixes[~there], low[~there], high[~there], np.ones(int((~there).sum()), dtype=bool)
            suffixes, low, high = suffixes[there], new_low[there], new_high[there]
            d += 1
            over = (tests.left if longest else tests.window)[suffixes] == d
            yield d, suffixes, low, high, over
            suffixes, low, high = suffixes[~over], low[~over], high[~over]


def expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, place) of all places of the ranges."""
    size = high - low
    which = np.repeat(np.arange(len(low)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]


class Found:
    """What is known of one document."""

    def __init__(self):
        self.n_words, self.spans, self.items = 0, [], set()


def joined(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Spans in order; those that touch or overlap are one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [{"start": a, "end": b} for a, b in out]


class Search:
    """Searches the tests in documents, shard by shard."""

    def __init__(self, tests: Tests, longest: bool = False):
        self.tests, self.longest = tests, longest
        #: (item suffix) -> (length, document, start), the longest matches so far; the first place of equals.
        self.best: dict[int, tuple[int, int, int]] = {}

    def shard(self, texts: list[bytes], found: list[Found], offsets: list[int], known: list[int], places: list[int]) -> Words:
        """Texts that make one shard. `offsets`: their first word's number; `known`: their leading words that are counted already."""
        words = Words(b"\n".join(texts))
        sizes = np.array([len(t) + 1 for t in texts])
        edges = np.concatenate(([0], np.searchsorted(words.start, np.cumsum(sizes))))
        for f, a, b, k in zip(found, edges[:-1], edges[1:], known, strict=True):
            f.n_words += int(b - a) - k
        n = len(words.key)
        if not n or not len(self.tests.key):
            return words
        doc = np.repeat(np.arange(len(texts)), np.diff(edges))
        keys = np.insert(words.key, edges[1:-1], np.uint64(0))
        array = Shard(keys, self.tests.depth)
        word_of = lambda p: p - np.searchsorted(edges[1:-1] + np.arange(len(texts) - 1), p)  # noqa: E731  places of the array as words
        if self.longest:
            for d, suffixes, low, high, over in array.ranges(self.tests, np.arange(len(self.tests.key)), True):
                for s, a, b in zip(suffixes[over].tolist(), low[over].tolist(), high[over].tolist(), strict=True):
                    if d >= self.best.get(s, (1, 0, 0))[0]:
                        p = word_of(array.order[a:b].astype(np.int64))
                        i, start = min(zip([places[k] for k in doc[p].tolist()], (p - edges[doc[p]] + np.array(offsets)[doc[p]]).tolist(), strict=True))
                        self.best[s] = min((self.best.get(s, (d, i, start))), (d, i, start), key=lambda e: (-e[0], e[1:]))
            return words
        marks = np.zeros(n + 1, dtype=np.int32)
        spelled: dict[bytes, tuple[bytes, ...]] = {}
        for d, suffixes, low, high, over in array.ranges(self.tests, self.tests.suffixes, False):
            which, at = expanded(low[over], high[over])
            p, codes = word_of(array.order[at].astype(np.int64)), self.tests.code[suffixes[over]][which]
            for w, c in zip(p.tolist(), codes.tolist(), strict=True):
                raw = words.text_of(w, w + d)
                if raw not in spelled:
                    if len(spelled) > 100_000:
                        spelled.clear()
                    spelled[raw] = plain(raw)
                if spelled[raw] == self.tests.spelled[c]:
                    marks[w] += 1
                    marks[w + d] -= 1
                    found[doc[w]].items |= self.tests.items[c]
        inside = np.concatenate(([0], (np.cumsum(marks)[:-1] > 0).astype(np.int8), [0]))
        for a, b in zip(np.flatnonzero(np.diff(inside) == 1).tolist(), np.flatnonzero(np.diff(inside) == -1).tolist(), strict=True):
            while a < b:  # a run may go on in the next text
                k = int(doc[a])
                end = min(b, int(edges[k + 1]))
                found[k].spans.append((a - int(edges[k]) + offsets[k], end - int(edges[k]) + offsets[k]))
                a = end
        return words

    def documents(self, texts: list[bytes], places: list[int]) -> list[Found]:
        """Results of the texts; small ones share shards."""
        found = [Found() for _ in texts]
        small: list[int] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if small:
                self.shard([texts[k] for k in small], [found[k] for k in small], [0] * len(small), [0] * len(small), [places[k] for k in small])
                small.clear()
                held = 0

        for k, text in enumerate(texts):
            if len(text) > SHARD_BYTES:
                self.pieces(text, found[k], places[k])
                continue
            if held + len(text) > SHARD_BYTES:
                flush()
            small.append(k)
            held += len(text) + 1
        flush()
        return found

    def pieces(self, text: bytes, found: Found, place: int) -> None:
        """A long text in pieces that overlap by the longest item."""
        at, first, known, size = 0, 0, 0, SHARD_BYTES
        while True:
            end = min(len(text), at + size)
            while end < len(text) and LOWERED[text[end]]:
                end += 1
            words = Words(text[at:end])
            m = len(words.key)
            back = min(m, self.tests.depth - 1)
            if end < len(text) and m <= 2 * back:
                size *= 2  # too few words to go on from
                continue
            self.shard([text[at:end]], [found], [first], [known], [place])
            if end == len(text):
                return
            at, first, known, size = (at + int(words.start[m - back]) if back else end), first + m - back, back, SHARD_BYTES


def item_rows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(quoted(item_col)).cast("string").alias("item_id"), F.col(quoted(text_col)).cast("binary").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")


def blocks_of(items: DataFrame) -> int:
    return max(1, -(-items.agg(F.coalesce(F.sum(F.length("text") + 64), F.lit(0)).alias("b")).first()["b"] // MAX_BENCHMARK_BYTES))


def told_items(items: DataFrame, blocks: int, block: int):
    """One block of items for all tasks."""
    got = (items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items).orderBy("item_id", "text").toArrow()
    return items.sparkSession.sparkContext.broadcast((got["item_id"].to_pylist(), got["text"].to_pylist()))


def held_batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Rows of about one shard at a time, or one larger row."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        a = 0
        for k, n in enumerate(lengths):
            if size and size + n > SHARD_BYTES:
                yield pa.Table.from_batches([*held, batch.slice(a, k - a)])
                held, size, a = [], 0, k
            size += n + 1
        held.append(batch.slice(a))
    if held:
        yield pa.Table.from_batches(held)


NEW = ("n_words", "spans", "item_ids")


def marked(docs: DataFrame, shared, window: int, text_col: str, passed: list[str]) -> DataFrame:
    """The `passed` columns of `docs` with n_words, spans and item_ids for one block of items."""
    own = next(x for i in range(len(docs.columns) + 1) if (x := f"text_{i}") not in docs.columns)
    rows = docs.select(*[F.col(quoted(c)) for c in passed], F.col(quoted(text_col)).cast("binary").alias(own))
    schema = T.StructType([*[rows.schema[c] for c in passed], *T._parse_datatype_string(f"n_words long, spans {SPANS}, item_ids array<string>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(Tests(*shared.value, window))
        for part in held_batches(batches, own):
            found = search.documents([t or b"" for t in part[own].to_pylist()], list(range(part.num_rows)))
            new = [pa.array([f.n_words for f in found], pa.int64()), pa.array([joined(f.spans) for f in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array([sorted(f.items) for f in found], pa.list_(pa.string()))]
            yield from pa.Table.from_arrays([*[part[c] for c in passed], *new], names=[*passed, *NEW]).combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def together(rows: DataFrame) -> DataFrame:
    """One row of each `row` from what several blocks found."""
    met = rows.groupBy("row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [joined([(s["start"], s["end"]) for s in x]) for x in batch.column("spans").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("spans"), "spans", pa.array(spans, batch.schema.field("spans").type))

    return met.mapInArrow(run, met.schema)


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", keep_text: bool = True) -> DataFrame:
    """`docs` with n_words, spans (words start to end that lie in occurring windows, disjoint, in order) and item_ids (of occurring windows, sorted as strings)."""
    items = item_rows(benchmark, item_col, item_text)
    blocks = blocks_of(items)
    docs = docs.drop(*NEW)
    passed = [c for c in docs.columns if keep_text or c != text_col]
    if blocks == 1:
        return marked(docs, told_items(items, 1, 0), window, text_col, passed)
    row = next(x for i in range(len(docs.columns) + 1) if (x := f"row_{i}") not in docs.columns)
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()))
    found = None
    for i in range(blocks):
        got = marked(numbered, told_items(items, blocks, i), window, text_col, [row]).withColumnRenamed(row, "row")
        found = got if found is None else found.unionAll(got)
    return numbered.join(together(found).withColumnRenamed("row", row), row).select(*[F.col(quoted(c)) for c in passed], *NEW)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, **names: str) -> DataFrame:
    """`docs` without the documents that hold a window of the benchmark."""
    return overlaps(docs, benchmark, window, **names).where(F.size("spans") == 0).drop(*NEW)


def longest_matches(docs: DataFrame, benchmark: DataFrame, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, item_start, length, doc_id, doc_start: for each suffix of an item its longest verbatim match of `min_words` words or more, at its first place (smallest id, then place).

    Rows with a null id take no part; of items that repeat an id, each place counts once, with its longest match.
    """
    items = item_rows(benchmark, item_col, item_text)
    blocks = blocks_of(items)
    rows = docs.where(F.col(quoted(id_col)).isNotNull()).select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).cast("binary").alias("text"))
    found = None
    for i in range(blocks):
        shared = told_items(items, blocks, i)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tests = Tests(*shared.value, min_words)
            search = Search(tests, longest=True)
            for part in held_batches(batches, "text"):
                search.documents([t or b"" for t in part["text"].to_pylist()], part["id"].to_pylist())
            out = [(tests.ids[tests.owner[s]], int(tests.item_start[s]), d, i, p) for s, (d, i, p) in search.best.items() if d >= min_words]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["item_id", "item_start", "length", "id", "doc_start"])

        got = rows.mapInArrow(run, "item_id string, item_start long, length long, id long, doc_start long")
        found = got if found is None else found.unionAll(got)
    first = found.groupBy("item_id", "item_start").agg(F.min(F.struct((-F.col("length")).alias("shorter"), "id", "doc_start")).alias("m"))
    return first.select("item_id", "item_start", (-F.col("m.shorter")).alias("length"), F.col("m.id").alias(id_col), "m.doc_start")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The counted columns of `overlaps`."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(id_col, "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


ORACLE = r"""
WITH told AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), asked AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS words
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM asked WHERE len(w) > 0)
), places AS (
  SELECT row, n, p, array_to_string(w[p : p + n - 1], ' ') AS words
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM told, (SELECT DISTINCT n FROM windows))
), hits AS (
  SELECT places.row, places.n, places.p, windows.item_id FROM places JOIN windows USING (n, words)
), words AS (
  SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(p, p + n)) AS k FROM (SELECT DISTINCT row, n, p FROM hits)) GROUP BY row
), items AS (
  SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT row, item_id FROM hits) GROUP BY row
)
SELECT told.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM told LEFT JOIN words USING (row) LEFT JOIN items USING (row)
"""
