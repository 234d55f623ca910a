"""Hard negatives by inner product: a PCA rotation discards early, whole-number products verify.

The rotation comes from the second moments of all rows, summed in tasks. It is orthogonal, so products
stay as they are and the leading components carry most of them. For a block of candidates the products
of some leading components are accumulated; what the others can add lies within the product of the two
residual norms, plus slack for rounding. A pair is discarded as soon as its interval misses everything that
is still asked for, and the rest goes on with more components. Pairs that survive are decided by exact
products of the grids, so the rotation affects speed and never a result.

Two passes over the candidates. The first finds each anchor's positives: its k best rows of the same label. The
second finds, for each positive with score p, the k best rows of other labels with a score from 0.8 p to p.
In both, the k-th best so far is carried from block to block of a task. Anchors go out to the tasks in sets
of bounded size, so that candidates are read where they lie and never shuffled.

Defined cases: rows with a null id, label or vector, an empty vector, or a null or non-finite component take no
part; vectors meet only others of their length; ties go to the smaller id. Rows that repeat an id are
one row: the one with the smallest label, then vector, is the anchor; among the positives of an anchor, and
among the negatives of a positive, an id counts once, with its best score. An anchor without rows of its label
has no positives; a positive with a score below zero has no negatives, as 0.8 p lies above p. An empty table
gives no rows; other columns are ignored. Components of any finite size are taken exactly (as Python integers where
a product may leave a long); a score beyond a long is given as the largest or smallest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaylake.llm._common import quoted, written
from assaylake.llm.topk import exact_type, ordered, quantised, rows_of, typed, usable_rows

BLOCK = 4096
#: Anchors that meet a block at once.
ANCHORS = 1024
#: Bytes of one set of anchors, which the driver passes on.
MAX_ANCHOR_BYTES = 64 << 20
#: Vectors longer than this are not rotated, and no more than so many lengths are: their residual bounds hold as they are.
MAX_ROTATED, MAX_LENGTHS = 1024, 8
#: Shares of the components after which pairs are discarded.
STAGES = (0.125, 0.375)
SLACK = 1e-9
MOST = (1 << 63) - 1
LOW, HIGH = 80, 100


def labelled_rows(vectors: DataFrame, label, id_col: str, vec_col: str) -> DataFrame:
    """(id, label, x), usable rows only; `label` is a column expression."""
    kept = usable_rows(vectors.withColumn("__row", F.struct(F.col(quoted(id_col)).cast("long").alias("id"), label.cast("long").alias("label"))), "__row", vec_col)
    return kept.select("id.id", "id.label", "x").where("id IS NOT NULL AND label IS NOT NULL")


def moments(rows: DataFrame) -> dict[int, np.ndarray]:
    """The sum of outer products of each common length, from all rows, with their scale taken out."""

    def add(got: dict[int, np.ndarray], length: int, m: np.ndarray) -> None:
        got[length] = got.get(length, 0) + m

    def told(got: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if got:
            yield pa.RecordBatch.from_pydict({"length": pa.array(list(got), pa.int32()), "m": pa.array([m.ravel().tolist() for m in got.values()], pa.list_(pa.float64()))})

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in rows_of(batch.column("x")):
                if length <= MAX_ROTATED and (length in got or len(got) < MAX_LENGTHS):
                    peak = np.abs(x).max(axis=1, keepdims=True)
                    u = x / np.where(peak > 0, peak, 1)
                    u /= np.maximum(np.sqrt((u * u).sum(axis=1, keepdims=True)), 1)  # a peak of 1 is in it, unless all is zero
                    add(got, length, u.T @ u)
        yield from told(got)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, m in zip(batch.column("length").to_pylist(), batch.column("m"), strict=True):
                add(got, length, m.values.to_numpy().reshape(length, length))
        yield from told(got)

    schema = "length int, m array<double>"
    width = max(1, round(rows.sparkSession.sparkContext.defaultParallelism**0.5))
    met = rows.select("x").mapInArrow(per_task, schema).repartition(width).mapInArrow(together, schema)  # so that few rows are left for the driver
    found: dict[int, np.ndarray] = {}
    for r in met.collect():
        add(found, r["length"], np.array(r["m"]).reshape(r["length"], r["length"]))
    return dict(sorted(found.items(), key=lambda e: (-np.trace(e[1]), e[0]))[:MAX_LENGTHS])


def rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """An orthogonal matrix for each common length, leading components first."""
    return {length: np.linalg.eigh(m)[1][:, ::-1].copy() for length, m in moments(rows).items()}


class Side:
    """Grids of one length with their rotated components and the norms of what remains after each stage."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, grid: np.ndarray, rotation: np.ndarray | None):
        self.ids, self.labels, self.grid, self.rotation = ids, labels, grid, rotation
        self.whole = grid.dtype == object or np.abs(grid).max(initial=0) > 1e150  # no bounds by doubles
        if not self.whole:
            self.turned = grid if rotation is None else grid @ rotation
            d = grid.shape[1]
            self.cuts = sorted({int(d * s) for s in STAGES if 0 < int(d * s) < d})
            self.rest = [np.sqrt((self.turned[:, c:] ** 2).sum(axis=1)) for c in self.cuts]
            self.norm = np.sqrt((self.turned**2).sum(axis=1))


def survivors(anchors: Side, block: Side, low: np.ndarray, high: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, row) whose score may lie within [low, high] of its anchor, labels equal or not as asked."""
    may = ((anchors.labels[:, None] == block.labels[None, :]) == same) & (anchors.ids[:, None] != block.ids[None, :])
    may &= (low <= high)[:, None]
    a, b = np.nonzero(may)
    if anchors.whole or block.whole or low.dtype == object:
        return a, b
    low, high = low.astype(np.float64), high.astype(np.float64)
    at, partial = 0, np.zeros(len(a))
    for stage, cut in enumerate(anchors.cuts):
        if len(a) * 8 > may.size:  # most pairs are left: one product of matrices
            partial = partial + (anchors.turned[:, at:cut] @ block.turned[:, at:cut].T)[a, b]
        else:
            partial = partial + dots(anchors.turned[:, at:cut], block.turned[:, at:cut], a, b)
        room = anchors.rest[stage][a] * block.rest[stage][b] + SLACK * anchors.norm[a] * block.norm[b] + SLACK
        good = (partial + room >= low[a]) & (partial - room <= high[a])
        a, b, partial, at = a[good], b[good], partial[good], cut
    return a, b


def dots(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the pairs, some at a time."""
    return np.concatenate([np.einsum("ij,ij->i", x[a[s : s + 65536]], y[b[s : s + 65536]]) for s in range(0, max(1, len(a)), 65536)])


def products(anchors: Side, block: Side, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of pairs."""
    kind = exact_type(block.grid, [anchors.grid]) if len(a) else np.int64
    if kind is object:
        x, y = typed(anchors.grid, kind), typed(block.grid, kind)
        return np.array([(x[i] * y[j]).sum() for i, j in zip(a.tolist(), b.tolist(), strict=True)], dtype=object)
    x, y = anchors.grid.astype(kind), block.grid.astype(kind)
    return ((x @ y.T)[a, b] if kind is np.float64 and len(a) * 8 > len(x) * len(y) else dots(x, y, a, b)).astype(np.int64)


class Mine:
    """The k best of all candidates seen for each band (anchor, key, low, high) of a set of anchors of one length."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, grid: np.ndarray, rotation: np.ndarray | None, bands: list[list[tuple[int, int, int]]], same: bool, k: int):
        """`bands`: for each anchor (key, low, high)."""
        self.k, self.same, self.rotation = k, same, rotation
        self.anchors = [Side(ids[s : s + ANCHORS], labels[s : s + ANCHORS], grid[s : s + ANCHORS], rotation) for s in range(0, len(ids), ANCHORS)]
        width = max(map(len, bands))
        told = [[*own, *[(0, 1, 0)] * (width - len(own))] for own in bands]
        wide = any(not ~MOST <= v <= MOST for own in told for _, *e in own for v in e)
        self.key = np.array([[e[0] for e in own] for own in told], dtype=np.int64)
        self.low, self.high = (np.array([[e[i] for e in own] for own in told], dtype=object if wide else np.int64) for i in (1, 2))
        self.n = np.zeros(self.key.shape, dtype=np.int64)
        self.ids = np.zeros((*self.key.shape, k), dtype=np.int64)
        self.scores = np.zeros((*self.key.shape, k), dtype=self.low.dtype)

    def widen(self) -> None:
        """From here on scores may leave a long; bounds at the ends of a long stand for none."""
        if self.low.dtype != object:
            self.low, self.high, self.scores = (v.astype(object) for v in (self.low, self.high, self.scores))
            self.low[self.low == ~MOST] = -(1 << 2300)
            self.high[self.high == MOST] = 1 << 2300

    def add(self, ids: np.ndarray, labels: np.ndarray, grid: np.ndarray) -> None:
        block = Side(ids, labels, grid, self.rotation)
        for c, anchors in enumerate(self.anchors):
            if exact_type(block.grid, [anchors.grid]) is object:
                self.widen()
            own = slice(c * ANCHORS, c * ANCHORS + len(anchors.ids))
            need = self.needed(own)
            live = need <= self.high[own]
            low, high = np.where(live, need, self.low.max()).min(axis=1), np.where(live, self.high[own], need.min()).max(axis=1)
            low, high = np.where(live.any(axis=1), low, 1), np.where(live.any(axis=1), high, 0)
            a, b = survivors(anchors, block, low, high, self.same)
            if len(a):
                self.keep(own.start, a, ids[b], products(anchors, block, a, b))

    def needed(self, own: slice) -> np.ndarray:
        """The score from which a row can still get into each band."""
        return np.where(self.n[own] == self.k, np.maximum(self.low[own], self.scores[own][:, :, -1]), self.low[own])

    def keep(self, start: int, a: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        a = a + start
        for s in range(0, len(a), 1 << 18):
            part = slice(s, s + (1 << 18))
            need = np.where(self.n[a[part]] == self.k, np.maximum(self.low[a[part]], self.scores[a[part]][:, :, -1]), self.low[a[part]])
            row, band = np.nonzero(((scores[part, None] >= need) & (scores[part, None] <= self.high[a[part]])).astype(bool))
            if len(row):
                self.merge(a[part][row] * self.key.shape[1] + band, ids[part][row], scores[part][row])

    def merge(self, band: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Old and new rows of the touched bands: an id once, the k first of each band."""
        n, old_ids, old = self.n.ravel(), self.ids.reshape(-1, self.k), self.scores.reshape(-1, self.k)  # views
        touched = np.unique(band)
        own, slot = np.nonzero(np.arange(self.k) < n[touched][:, None])
        band = np.concatenate((band, touched[own]))
        ids = np.concatenate((ids, old_ids[touched[own], slot]))
        scores = np.concatenate((scores, old[touched[own], slot]))
        down = -np.unique(scores, return_inverse=True)[1]
        order = np.lexsort((down, ids, band))
        first = np.ones(len(order), dtype=bool)
        first[1:] = (band[order][1:] != band[order][:-1]) | (ids[order][1:] != ids[order][:-1])
        order = order[first]
        order = order[np.lexsort((ids[order], down[order], band[order]))]
        edge = np.flatnonzero(np.concatenate(([True], band[order][1:] != band[order][:-1])))
        place = np.arange(len(order)) - np.repeat(edge, np.diff([*edge, len(order)]))
        order, place = order[place < self.k], place[place < self.k]
        old_ids[band[order], place], old[band[order], place] = ids[order], scores[order]
        n[touched] = np.bincount(np.searchsorted(touched, band[order]), minlength=len(touched))

    def told(self) -> Iterator[pa.RecordBatch]:
        a, band, slot = np.nonzero(np.arange(self.k) < self.n[:, :, None])
        anchors = np.concatenate([s.ids for s in self.anchors])
        for s in range(0, len(a), 1 << 16):
            part = slice(s, s + (1 << 16))
            scores = self.scores[a[part], band[part], slot[part]].tolist()
            yield pa.RecordBatch.from_pydict({
                "anchor_id": pa.array(anchors[a[part]]), "key": pa.array(self.key[a[part], band[part]]), "id": pa.array(self.ids[a[part], band[part], slot[part]]),
                "score": pa.array([max(~MOST, min(MOST, x)) for x in scores], pa.int64()), "beyond": pa.array([(x > MOST) - (x < ~MOST) for x in scores], pa.int32()),
                "exact": pa.array([None if ~MOST <= x <= MOST else ordered(x) for x in scores], pa.binary()),
            })


FOUND = "anchor_id long, key long, id long, score long, beyond int, exact binary"


def whole(score: int, exact: bytes | None) -> int:
    """A score from its columns; see topk.ordered."""
    if exact is None:
        return score
    raw = exact if score > 0 else bytes(255 - b for b in exact)
    return int.from_bytes(raw[4:], "big") * (1 if score > 0 else -1)


def search(rows: DataFrame, asked: DataFrame, n_sets: int, turn: dict[int, np.ndarray], same: bool, k: int, scale: int) -> DataFrame:
    """FOUND rows with rank up to k for the bands of `asked` (id, label, x, bands), in sets of anchors that go out to all tasks."""
    context = rows.sparkSession.sparkContext
    parts = []
    for i in range(n_sets):
        got = (asked.where(F.pmod(F.xxhash64("id"), F.lit(n_sets)) == i) if n_sets > 1 else asked).toArrow().combine_chunks()
        shared = context.broadcast((got, turn))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            told, turn = shared.value
            mines: dict[int, Mine] = {}
            if told.num_rows:
                ids, labels, bands = told["id"].to_numpy(), told["label"].to_numpy(), told["bands"].to_pylist()
                for length, x_ids, x in grouped(rows_of(told["x"].combine_chunks())):
                    wanted = [[(e["key"], -((-LOW * p) // HIGH), p) if not e["open"] else (e["key"], ~MOST, MOST) for e in bands[r] for p in (whole(e["score"], e["exact"]),)] for r in x_ids.tolist()]
                    mines[length] = Mine(ids[x_ids], labels[x_ids], quantised(x, scale), turn.get(length), wanted, same, k)
            held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

            def work(length: int) -> None:
                ids, labels, x = (np.concatenate(v) for v in zip(*held.pop(length), strict=True))
                for s in range(0, len(ids), BLOCK):
                    mines[length].add(ids[s : s + BLOCK], labels[s : s + BLOCK], quantised(x[s : s + BLOCK], scale))

            for batch in batches:
                ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
                for length, place, x in rows_of(batch.column("x")):
                    if length in mines:
                        own = held.setdefault(length, [])
                        own.append((ids[place], labels[place], x))
                        if sum(len(h[0]) for h in own) >= BLOCK:
                            work(length)
            for length in list(held):
                work(length)
            for m in mines.values():
                yield from m.told()

        parts.append(rows.mapInArrow(run, FOUND))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    order = (F.desc("beyond"), F.desc("exact"), F.desc("score"))
    once = found.withColumn("again", F.row_number().over(Window.partitionBy("anchor_id", "key", "id").orderBy(*order))).where("again = 1").drop("again")
    return once.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_id", "key").orderBy(*order, "id"))).where(F.col("rank") <= k)


def grouped(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The parts of each length together."""
    got: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for length, place, x in parts:
        got.setdefault(length, []).append((place, x))
    for length, own in got.items():
        yield length, np.concatenate([p for p, _ in own]), np.concatenate([x for _, x in own])


def mine(vectors: DataFrame, label=None, anchor_every: int = 100, positives: int = 5, negatives: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Runs its first pass while the frame is built.

    `label` is a column expression over `vectors` (its column `label` if left out); anchors are the rows whose id `anchor_every` divides.
    """
    rows = labelled_rows(vectors, F.col("label") if label is None else label, id_col, vec_col)
    chosen = rows.where(F.pmod("id", F.lit(anchor_every)) == 0).groupBy("id").agg(F.min(F.struct("label", "x")).alias("r"))
    asked = written(chosen.select("id", "r.label", "r.x"))
    size = asked.agg(F.coalesce(F.sum(F.size("x") * 8 + 64 + 48 * positives), F.lit(0)).alias("b")).first()["b"]
    n_sets, turn = max(1, -(-size // MAX_ANCHOR_BYTES)), rotations(rows)
    open_band = F.array(F.struct(F.lit(0).cast("long").alias("key"), F.lit(True).alias("open"), F.lit(0).cast("long").alias("score"), F.lit(None).cast("binary").alias("exact")))
    best = written(search(rows, asked.withColumn("bands", open_band), n_sets, turn, True, positives, scale))
    bands = best.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("id").alias("key"), F.lit(False).alias("open"), "score", "exact")).alias("bands"))  # `positives` of them at most
    found = search(rows, asked.join(bands, asked["id"] == bands["anchor_id"]).select("id", "label", "x", "bands"), n_sets, turn, False, negatives, scale)
    pairs = best.select("anchor_id", F.col("id").alias("key"), F.col("score").alias("positive_score"))
    return found.join(pairs, ["anchor_id", "key"]).select("anchor_id", F.col("key").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM s WHERE same) WHERE r <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
) WHERE rank <= 5
"""
