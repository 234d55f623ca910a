"""Lloyd clustering on integer grids, filtered by ball trees.

Each task cuts its vectors into blocks and builds a metric tree over each: a node holds the count, the
integer sum and the radius of its ball, and a leaf the rows themselves. Trees are written once to the shared
folder. In a round a node keeps the centroids that can be nearest to some point of its ball: centroid j goes
when another one is nearer to the ball's centre by more than the ball's diameter (triangle inequality). A
ball that is left with one centroid is added whole, by its sum and count; an open leaf is settled row by
row with exact integer distances. Strict inequalities with slack for rounding decide about balls, so ties
are met in leaves only. What leaves a task is k rows of sums; Spark adds them up, and the k centroids
are all that the driver sees.

Sums go in digits of base 2^40, each its own row, so that components of any finite size are added exactly.

Defined cases: a vector that is null, of another length, or holds a null or non-finite component takes
no part; ties go to the smaller centroid number; rows that repeat an id are vectors of their own, and starts
with one hash go by their components; a null id has no hash and comes last as a start, and is returned
as null; with fewer vectors than k there are as many centroids as vectors; an empty table gives no rows; an
empty centroid stays where it is; other columns are ignored. A distance or sum beyond a long is given as
the largest long and is compared by its exact value.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm._common import quoted, written

#: Rows of a tree and of a leaf.
BLOCK, LEAF = 4096, 96
#: Grids up to this size have squared distances below 2^53, so that doubles are exact.
NARROW = 1 << 20
#: A centroid with a larger component is farther from a narrow row than any narrow centroid.
FAR = 1 << 25
#: Far more than the rounding of a distance between narrow vectors of some thousand components.
SLACK = 1e-3
DIGIT = 40
MOST = (1 << 63) - 1
TREES = "ids binary, tree binary"
SUMS = "cluster int, dim int, digit int, s long"


def usable_rows(vectors: DataFrame, dims: int, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) with x as doubles: vectors of `dims` finite components."""
    x = F.transform(F.col(quoted(vec_col)), lambda c: c.cast("double"))
    rows = vectors.select(F.col(quoted(id_col)).cast("long").alias("id"), x.alias("x"))
    return rows.where(f"size(x) = {dims} AND forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))")


def grid_of(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): doubles where they are narrow, else Python integers."""
    with np.errstate(over="ignore"):
        grid = np.floor(x * scale)
    if not len(grid) or np.abs(grid).max() <= NARROW:
        return grid
    return whole_grid(x, scale)


def whole_grid(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as Python integers; a component of 2^53 or more is whole before it is scaled."""
    return np.array([[math.floor(c * scale) if abs(c) < 1 << 53 else int(c) * scale for c in row] for row in x.tolist()], dtype=object)


class Tree:
    """A block's rows in leaf order with its nodes; a child stands after its parent."""

    def __init__(self, rows: np.ndarray):
        order = np.arange(len(rows))
        at: list[tuple[int, int, int]] = [(-1, 0, len(rows))]  # parent, range of `order`
        self.leaf = []
        k = 0
        while k < len(at):
            _, a, b = at[k]
            own = order[a:b]
            inner = b - a > LEAF and rows.dtype != object
            if inner:
                x = rows[own]
                far = x[np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1))]
                other = x[np.argmax(((x - far) ** 2).sum(axis=1))]
                inner = bool((far != other).any())  # equal rows make one leaf
                if inner:
                    order[a:b] = own[np.argsort(x @ (other - far), kind="stable")]
                    mid = (a + b) // 2
                    at += [(k, a, mid), (k, mid, b)]
            self.leaf.append(not inner)
            k += 1
        self.order, self.rows = order, rows[order]
        self.parent, self.start, self.end = np.array(at).T
        self.rows = self.rows.astype(np.int32) if rows.dtype != object else self.rows
        self.sums = np.array([self.rows[a:b].sum(axis=0) for _, a, b in at])
        self.radius = np.zeros(len(at))
        if rows.dtype != object:
            for n, (_, a, b) in enumerate(at):
                self.radius[n] = math.sqrt(((self.rows[a:b] - self.sums[n] / (b - a)) ** 2).sum(axis=1).max()) + SLACK

    def rows_of(self, n: int) -> np.ndarray:
        return self.rows[self.start[n] : self.end[n]]


def distances(rows: np.ndarray, centroids: list[list[int]], among: np.ndarray) -> np.ndarray:
    """Exact squared distances to the centroids named by `among`, of one type."""
    c = [centroids[j] for j in among]
    narrow = rows.dtype != object
    peak = max(abs(v) for row in c for v in row)
    if narrow and peak <= NARROW:
        x, y = rows.astype(np.float64), np.array(c, dtype=np.float64)
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)
    if narrow and peak <= FAR:
        return np.array([((rows.astype(np.int64) - np.array(v)) ** 2).sum(axis=1) for v in c]).T
    y = np.array(c, dtype=object)
    return np.array([[((row - v) ** 2).sum() for v in y] for row in rows.astype(object)], dtype=object)


class Filter:
    """One round of one tree: whole balls and settled rows by centroid."""

    def __init__(self, tree: Tree, centroids: list[list[int]]):
        self.tree, self.centroids = tree, centroids
        near = [j for j, c in enumerate(centroids) if max(map(abs, c)) <= NARROW]
        narrow = tree.rows.dtype != object
        #: Far centroids never win a narrow row while a narrow one is there.
        self.may = np.array([j for j, c in enumerate(centroids) if not (narrow and near and max(map(abs, c)) > FAR)])
        self.exact_only = not narrow or len(near) < len(self.may)

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
        """(node, centroids of its rows, their distances or None for a whole ball); every row in one part."""
        t = self.tree
        if self.exact_only:
            for n in np.flatnonzero(t.leaf).tolist():
                yield self.settle(n, self.may)
            return
        c = np.array([self.centroids[j] for j in self.may], dtype=np.float64)
        centres = t.sums / (t.end - t.start)[:, None]
        d = np.sqrt(np.maximum(((centres[:, None, :] - c[None]) ** 2).sum(axis=2), 0)) if len(c) <= 64 else np.array([np.sqrt(((x - c) ** 2).sum(axis=1)) for x in centres])
        keep = d <= d.min(axis=1, keepdims=True) + (2 * t.radius + SLACK)[:, None]
        done = np.zeros(len(t.leaf), dtype=bool)
        for n in range(len(t.leaf)):
            p = t.parent[n]
            if p >= 0:
                if done[p]:
                    done[n] = True
                    continue
                keep[n] &= keep[p]
            if keep[n].sum() == 1:
                done[n] = True
                yield n, self.may[keep[n]], None
            elif t.leaf[n]:
                yield self.settle(n, self.may[keep[n]])

    def settle(self, n: int, among: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        d = distances(self.tree.rows_of(n), self.centroids, among)
        first = d.argmin(axis=1)  # the first of equals has the smaller number
        return n, among[first], d[np.arange(len(d)), first]


def trees(rows: DataFrame, dims: int, scale: int) -> DataFrame:
    """One row a block: ids in leaf order and the tree. Rows with large components make blocks of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[tuple[list, np.ndarray]]] = {False: [], True: []}

        def told(wide: bool) -> Iterator[pa.RecordBatch]:
            ids, grids = [i for h in held[wide] for i in h[0]], np.concatenate([h[1] for h in held[wide]])
            held[wide] = []
            for a in range(0, len(ids), BLOCK):
                tree = Tree(grids[a : a + BLOCK])
                own = pa.array([ids[a + i] for i in tree.order.tolist()], pa.int64())
                yield pa.RecordBatch.from_pydict({"ids": pa.array([pickle.dumps(own.to_pylist() if own.null_count else own.to_numpy())], pa.binary()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

        for batch in batches:
            ids = batch.column("id").to_pylist()
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            wide = np.abs(x).max(axis=1, initial=0) >= NARROW // scale
            for kind in (False, True):
                own = np.flatnonzero(wide == kind)
                if len(own):
                    held[kind].append(([ids[i] for i in own], (whole_grid if kind else grid_of)(x[own], scale)))
                    if sum(len(h[0]) for h in held[kind]) >= BLOCK:
                        yield from told(kind)
        for kind in (False, True):
            if held[kind]:
                yield from told(kind)

    return rows.mapInArrow(run, TREES)


def digits(n: int) -> Iterator[tuple[int, int]]:
    """n as digits of base 2^40 with its sign; the last takes the rest while it fits 60 bits."""
    sign, n, k = (-1 if n < 0 else 1), abs(n), 0
    while n >> 60:
        yield k, sign * (n & ((1 << DIGIT) - 1))
        n, k = n >> DIGIT, k + 1
    yield k, sign * n


def round_sums(blocks: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of every centroid that has vectors."""
    dims = len(centroids[0])
    shared = blocks.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for raw in batch.column("tree"):
                tree = pickle.loads(raw.as_buffer())
                for n, which, d in Filter(tree, shared.value).parts():
                    if d is None:
                        got = [(int(which[0]), tree.sums[n], int(tree.end[n] - tree.start[n]))]
                    else:
                        got = [(int(j), tree.rows_of(n)[which == j].sum(axis=0), int((which == j).sum())) for j in np.unique(which)]
                    for j, s, count in got:
                        total[j] = total.get(j, 0) + np.append(s.astype(object), count)
        rows = [(j, k, digit, v) for j, s in total.items() for k, n in enumerate(s.tolist()) for digit, v in digits(int(n))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["cluster", "dim", "digit", "s"])

    found: dict[int, list[int]] = {}
    for r in blocks.select("tree").mapInArrow(run, SUMS).groupBy("cluster", "dim", "digit").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        found.setdefault(r["cluster"], [0] * (dims + 1))[r["dim"]] += int(r["s"]) << (DIGIT * r["digit"])
    shared.unpersist()
    return {j: (s[dims], s[:dims]) for j, s in found.items()}


def assigned(blocks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """id, cluster, distance of every vector."""
    shared = blocks.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw in zip(batch.column("ids"), batch.column("tree"), strict=True):
                tree = pickle.loads(raw.as_buffer())
                cluster, distance = np.zeros(len(tree.rows), dtype=np.int32), np.zeros(len(tree.rows), dtype=np.int64)
                for n, which, d in Filter(tree, shared.value).parts():
                    own = slice(tree.start[n], tree.end[n])
                    if d is None:
                        d = distances(tree.rows[own], shared.value, which)[:, 0]
                    cluster[own], distance[own] = which, [min(int(v), MOST) for v in d.tolist()] if d.dtype == object else d
                yield pa.RecordBatch.from_pydict({"id": pa.array(pickle.loads(ids.as_buffer()), pa.int64()), "cluster": pa.array(cluster), "distance": pa.array(distance)})

    return blocks.mapInArrow(run, "id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256. Runs its rounds while the frame is built."""
    usable = usable_rows(vectors, dims, id_col, vec_col)
    starts = usable.orderBy(F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256).asc_nulls_last(), "x").limit(k).collect()
    centroids = [[int(v) for v in grid_of(np.array([r["x"]]), scale)[0].tolist()] for r in starts]
    spark, limit = vectors.sparkSession, F.lit(MOST).cast("decimal(38,0)")
    empty = spark.createDataFrame([], f"{quoted(id_col)} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    if not centroids:
        return empty
    blocks = written(trees(usable, dims, scale))
    for _ in range(rounds):
        for j, (n, s) in round_sums(blocks, centroids).items():
            centroids[j] = [v // n for v in s]
    rows = written(assigned(blocks, centroids))
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    told = [(j, min(s, MOST), min(sum(sums.values()), MOST), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for j, s in sums.items()]
    of = F.broadcast(spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))
    return rows.join(of, "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> str:
    """The same by plain assignment of every vector to every centroid."""
    near = lambda c: f"SELECT row, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM (SELECT v.row, c.c, list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d FROM v, {c} c) GROUP BY row"
    step = lambda r: f"""
a{r} AS MATERIALIZED ({near(f"c{r}")}),
m{r} AS (SELECT c, j, (s - ((s % n) + n) % n) // n AS m FROM (SELECT a.c, u.j, sum(v.e[u.j])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{r} a JOIN v USING (row), (SELECT unnest(range(1, {dims + 1})) AS j) u GROUP BY a.c, u.j)),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(n.e, c{r}.e) AS e FROM c{r} LEFT JOIN (SELECT c, list(m::BIGINT ORDER BY j) AS e FROM m{r} GROUP BY c) n USING (c)),"""  # noqa: E731
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, e FROM v ORDER BY h NULLS LAST, e LIMIT {k})),{"".join(map(step, range(rounds)))}
z AS MATERIALIZED ({near(f"c{rounds}")})
SELECT v.vec_id, CAST(z.c AS INTEGER) AS cluster, CAST(z.d AS BIGINT) AS distance, CAST(sum(z.d) OVER (PARTITION BY z.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(z.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM z JOIN v USING (row) JOIN c{rounds} c ON c.c = z.c
"""


ORACLE = oracle()
