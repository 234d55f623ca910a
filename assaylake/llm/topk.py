"""Exact top-k by integer inner product: the threshold algorithm over sorted per-dimension lists.

Candidates are read in blocks. A block keeps, for each dimension, its rows sorted by that component.
For a query the lists are walked in step, from the top where the query's component is positive and
from the bottom where it is negative; every row that comes up is scored in full. The walk stops when
the bound (the sum of the components at the current depth, weighed by the query) is below the k-th
best score so far, so rows not seen cannot get in, ties included. The k-th best is carried from block
to block of a task, and each task gives k rows a query, which Spark merges.

The query set may grow with the data. While it is within `MAX_QUERY_BYTES`, it is broadcast and the
candidates stay where they are. Beyond it, queries are dealt to blocks by a hash, candidates to groups, and
every block meets every group in a task of its own; nothing passes through the driver.

Defined cases: vectors that are null, empty or hold a null or non-finite component take no part;
vectors meet only others of their length; ties go to the smaller id; rows that repeat an id count
once, with their best score; of queries that repeat an id the one with the smallest vector counts;
rows with a null id take no part; an empty table gives no rows; other columns are ignored.
Components of any finite size are taken exactly: products that may not fit a long are Python integers;
a score beyond a long is ranked by its exact value and given as the largest or smallest long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaylake.llm._common import quoted

BLOCK = 8192
MAX_QUERY_BYTES = 64 << 20
FIRST_DEPTH = 32


def usable_rows(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) with the components as doubles, usable rows only."""
    x = F.transform(F.col(quoted(vec_col)), lambda c: c.cast("double"))
    rows = vectors.select(F.col(quoted(id_col)).alias("id"), x.alias("x"))
    return rows.where("id IS NOT NULL AND size(x) > 0 AND forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))")


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as whole doubles, or as Python integers where a double is too small for the product."""
    with np.errstate(over="ignore"):
        grid = np.floor(x * scale)
    return grid if np.isfinite(grid).all() else np.array([[int(c) * scale if abs(c) >= 1 << 53 else math.floor(c * scale) for c in row] for row in x.tolist()], dtype=object)


def exact_type(rows: np.ndarray, queries: list[np.ndarray]) -> type:
    """The fastest type in which all inner products are exact."""
    peak = max(1, int(np.abs(rows).max())) * max(max(1, int(np.abs(q).max())) for q in queries) * rows.shape[1]
    return np.float64 if peak < 1 << 53 else np.int64 if peak < 1 << 63 else object


def typed(rows: np.ndarray, kind: type) -> np.ndarray:
    return np.array([[int(c) for c in row] for row in rows.tolist()], dtype=object).reshape(rows.shape) if kind is object else rows.astype(kind)


class Block:
    """Candidates of one length with their sorted lists."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.order = np.argsort(rows, axis=0, kind="stable").T.copy()  # dimension x rank, ascending
        self.sorted = np.take_along_axis(rows.T, self.order, axis=1)

    def search(self, query: np.ndarray, own: int, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The k best (-score, id) of `best` and this block; both have one of the types of `exact_type`."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, dtype=bool)
        at, depth = 0, FIRST_DEPTH
        while at < n:
            end = min(n, at + depth)
            fresh = np.unique(np.concatenate((self.order[up, n - end : n - at].ravel(), self.order[down, at:end].ravel()))) if len(up) + len(down) else np.arange(n)
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            if len(fresh):
                best = merge(best, self.rows[fresh] @ query, self.ids[fresh], own, k)
            if not len(up) + len(down) or seen.all():
                break
            if len(best) == k and end < n:
                bound = query[up] @ self.sorted[up, n - end] + query[down] @ self.sorted[down, end - 1]
                if bound < -best[-1][0]:
                    break
            at, depth = end, 2 * depth
        return best


def merge(best: list[tuple[int, int]], scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k first of old and new (-score, id) pairs, an id once and never the query's own."""
    if len(best) == k:
        good = scores >= -best[-1][0]
        scores, ids = scores[good], ids[good]
    good = ids != own
    scores, ids = scores[good], ids[good]
    if len(scores) > 4 * k:  # repeated ids may stand among the first k
        distinct, where = np.unique(ids, return_inverse=True)
        rising, top = np.argsort(scores, kind="stable"), np.empty(len(distinct), dtype=np.int64)
        top[where[rising]] = rising  # an id's last entry has its best score
        rank = np.unique(scores[top], return_inverse=True)[1]
        first = np.lexsort((distinct, -rank))[:k]
        scores, ids = scores[top[first]], distinct[first]
    found: dict[int, int] = {}
    for s, i in [*best, *zip([-int(x) for x in scores.tolist()], ids.tolist(), strict=True)]:
        found[i] = min(s, found.get(i, s))
    return sorted((s, i) for i, s in found.items())[:k]


def rows_of(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, components) of a column of vectors, length by length."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
    lengths = np.diff(offsets)
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        for a in range(0, len(own), BLOCK):
            part = own[a : a + BLOCK]
            yield length, part, values[offsets[part][:, None] + np.arange(length)]


class Search:
    """The k best of all candidates seen for a set of queries."""

    def __init__(self, k: int, scale: int):
        self.k, self.scale = k, scale
        self.queries: dict[int, dict[int, np.ndarray]] = {}
        self.best: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def ask(self, ids: np.ndarray, column: pa.ListArray) -> None:
        for length, part, x in rows_of(column):
            own = self.queries.setdefault(length, {})
            for i, q in zip(ids[part].tolist(), quantised(x, self.scale), strict=True):
                if i not in own or tuple(q) < tuple(own[i]):
                    own[i] = q

    def add(self, ids: np.ndarray, column: pa.ListArray) -> None:
        for length, part, x in rows_of(column):
            if length in self.queries:
                held = self.waiting.setdefault(length, [])
                held.append((ids[part], x))
                if sum(len(h[0]) for h in held) >= BLOCK:
                    self.work(length)

    def work(self, length: int) -> None:
        ids, rows = (np.concatenate(x) for x in zip(*self.waiting.pop(length), strict=True))
        rows, queries = quantised(rows, self.scale), self.queries[length]
        kind = exact_type(rows, list(queries.values()))
        block = Block(ids, typed(rows, kind))
        for q, v in queries.items():
            self.best[length, q] = block.search(typed(v.reshape(1, -1), kind)[0], q, self.k, self.best.get((length, q), []))

    def told(self) -> Iterator[pa.RecordBatch]:
        for length in list(self.waiting):
            self.work(length)
        rows = [(q, i, -s) for (_, q), found in self.best.items() for s, i in found]
        if rows:
            q, i, s = zip(*rows, strict=True)
            most = (1 << 63) - 1
            yield pa.RecordBatch.from_pydict({
                "query_id": pa.array(q, pa.int64()), "id": pa.array(i, pa.int64()), "score": pa.array([max(~most, min(most, x)) for x in s], pa.int64()),
                "beyond": pa.array([(x > most) - (x < ~most) for x in s], pa.int32()), "exact": pa.array([None if ~most <= x <= most else ordered(x) for x in s], pa.binary()),
            })


def ordered(x: int) -> bytes:
    """Bytes that sort like the numbers of one sign."""
    size = abs(x).bit_length() // 8 + 1
    out = size.to_bytes(4, "big") + abs(x).to_bytes(size, "big")
    return out if x >= 0 else bytes(255 - b for b in out)


FOUND = "query_id long, id long, score long, beyond int, exact binary"


def top_k(vectors: DataFrame, query_every: int = 50, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score: the k best of all other rows for each row whose id `query_every` divides."""
    usable = usable_rows(vectors, id_col, vec_col)
    asked = usable.where(F.pmod("id", F.lit(query_every)) == 0)
    size = asked.agg(F.coalesce(F.sum(F.size("x") * 8 + 64), F.lit(0)).alias("b")).first()["b"]
    partial = broadcast_search(usable, asked, k, scale) if size <= MAX_QUERY_BYTES else block_search(usable, asked, k, scale, -(-size // MAX_QUERY_BYTES))
    order = (F.desc("beyond"), F.desc("exact"), F.desc("score"))
    once = Window.partitionBy("query_id", "id").orderBy(*order)
    best = partial.withColumn("again", F.row_number().over(once)).where("again = 1")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order, "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def broadcast_search(usable: DataFrame, asked: DataFrame, k: int, scale: int) -> DataFrame:
    """Queries of MAX_QUERY_BYTES at most go out to all tasks."""
    got = asked.toArrow().combine_chunks()
    shared = usable.sparkSession.sparkContext.broadcast(got)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Search(k, scale)
        for part in shared.value.to_batches():
            own.ask(part.column("id").to_numpy(), part.column("x"))
        for batch in batches:
            own.add(batch.column("id").to_numpy(), batch.column("x"))
        yield from own.told()

    return usable.mapInArrow(run, FOUND)


def block_search(usable: DataFrame, asked: DataFrame, k: int, scale: int, blocks: int) -> DataFrame:
    """Queries in blocks, candidates in groups; a task's key is one block and one group."""
    groups = usable.sparkSession.sparkContext.defaultParallelism
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("id", "x"), F.lit(n)).cast("int")
    queries = asked.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), every(groups).alias("group"), F.lit(0).alias("role"), "id", "x")
    rows = usable.select(every(blocks).alias("block"), dealt(groups).alias("group"), F.lit(1).alias("role"), "id", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, Search(k, scale)
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("block", "group", "role")]
            edges = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])))) if batch.num_rows else []
            for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
                now, part = (int(columns[0][a]), int(columns[1][a])), batch.slice(a, b - a)
                if now != key:
                    yield from own.told()
                    key, own = now, Search(k, scale)
                (own.add if columns[2][a] else own.ask)(part.column("id").to_numpy(), part.column("x"))
        yield from own.told()

    met = queries.unionByName(rows).repartition("block", "group").sortWithinPartitions("block", "group", "role")
    return met.mapInArrow(run, FOUND)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5
"""
