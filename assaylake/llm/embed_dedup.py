"""Embedding near-duplicates: cross-polytope hashing with multiprobe, verified pairs, exact link counts.

Equal vectors of a label are one class, which is compared once. Each of `tables` tables turns a class
vector by two pseudo-random rotations (three rounds of random signs and a fast Hadamard transform
each) and takes the nearest vertex of the cross-polytope in both: the pair is its home bucket. It
also visits the `visits` buckets in which the choice that is closest to a tie falls the other way.
Residents of a bucket meet each other and the visitors; cosines are taken in double precision, so
no pair below the threshold links. A pair may meet in several tables: the codes that travel with
each row tell in which meeting it meets first, and only that one counts, so link counts need no list
of pairs. What leaves a task are counts and a spanning forest of the links it has found.

Buckets with more than `TILE` residents are dealt to tiles; residents and visitors go to every tile
they have to meet, so memory is bounded and a hot bucket is shared by many tasks.

Measured recall of pairs against brute force is in the tests and the README.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component, rows with a
null label and rows with a null id link with nothing and are their own component; repeated vectors
link with each other; rows that repeat an id count as vectors of their own in n_links; vectors of
different lengths never link; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm._common import cut, quoted, written
from assaylake.operators.graph import connected_components
from assaylake.llm.simhash import forest

TILE = 4096
#: Hot buckets beyond this number are joined by a shuffle, not by a broadcast.
MAX_HOT = 100_000
#: Scalars of one block of cosines.
CELLS = 1 << 20
SEED = 20240229


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the number of columns is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(len(x), n)
        h *= 2
    return x


def vertices(x: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two nearest vertices of each rotated row and how much nearer the first is."""
    for s in signs:
        x = hadamard(x * s)
    size = np.abs(x)
    first = size.argmax(axis=1)
    row = np.arange(len(x))
    top = size[row, first]
    size[row, first] = -1
    second = size.argmax(axis=1)
    code = np.stack((2 * first + (x[row, first] < 0), 2 * second + (x[row, second] < 0)), axis=1)
    return code, (top - size[row, second]) / np.where(top > 0, top, 1)


def codes(unit: np.ndarray, tables: int, visits: int) -> np.ndarray:
    """rows x tables x (1 + visits): home bucket, then the visited ones."""
    n, d = unit.shape
    wide = 1 << max(0, d - 1).bit_length()
    x = np.zeros((n, wide))
    x[:, :d] = unit
    rng = np.random.default_rng(SEED)
    out = np.zeros((n, tables, 1 + visits), dtype=np.int32)
    for t in range(tables):
        (a, near_a), (b, near_b) = (vertices(x, rng.choice([-1.0, 1.0], size=(3, wide))) for _ in range(2))
        m = 2 * wide
        flips = np.stack((a[:, 1] * m + b[:, 0], a[:, 0] * m + b[:, 1], a[:, 1] * m + b[:, 1]), axis=1)
        swap = near_b < near_a
        flips[swap, :2] = flips[swap, 1::-1]
        out[:, t, 0] = a[:, 0] * m + b[:, 0]
        out[:, t, 1:] = flips[:, :visits]
    return out


def code_type(length: int) -> type:
    """The smallest type that holds the buckets of vectors of this length."""
    return np.int16 if (2 << max(0, length - 1).bit_length()) ** 2 <= 1 << 15 else np.int32


def raw_rows(column: pa.Array, length: int, rows: np.ndarray) -> np.ndarray:
    return column.values.to_numpy()[column.offsets.to_numpy()[rows][:, None] + np.arange(length)]


def unit_rows(raw: np.ndarray) -> np.ndarray:
    """Rows in double precision and of length one."""
    x = raw.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])  # by a power of two: exact, and no norm overflows
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def classes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(all rows with their class key, one row per class of usable vectors)."""
    kind = vectors.schema[vec_col].dataType.elementType.simpleString()
    zero = F.lit(0).cast(kind)
    rows = vectors.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).alias("label"), F.transform(F.col(quoted(vec_col)), lambda x: x + zero).alias("v"))
    finite = F.expr(f"size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < {kind}('Infinity')) AND exists(v, x -> x != 0)")
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
    keyed = rows.select("id", "label", "v", F.when(usable, F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b"))).alias("key"))
    reps = keyed.where("key IS NOT NULL").groupBy("label", "key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"), F.first("v").alias("v"))
    return keyed.select("id", "label", "key"), written(reps)


def placed(reps: DataFrame, tables: int, visits: int) -> DataFrame:
    """A row for each bucket that a class lives in (role 0) or visits (role 2), with its vector, as it came, and codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                column = batch.column("v")
                lengths = np.diff(column.offsets.to_numpy())
                for length in np.unique(lengths).tolist():
                    own = np.flatnonzero(lengths == length)
                    raw = raw_rows(column, length, own)
                    code = codes(unit_rows(raw), tables, visits)
                    n, each = len(own), tables * (1 + visits)
                    source = np.repeat(np.arange(n), each)
                    vectors, marks = [x.tobytes() for x in raw], [x.tobytes() for x in code.astype(code_type(length))]
                    yield pa.RecordBatch.from_pydict({
                        "label": batch.column("label").take(pa.array(own[source])),
                        "length": pa.array(np.full(n * each, length, dtype=np.int32)),
                        "tab": pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), 1 + visits), n)),
                        "bucket": pa.array(code.reshape(-1)),
                        "role": pa.array(np.tile(np.array([0, *[2] * visits], dtype=np.int32), n * tables)),
                        "rep": batch.column("rep").take(pa.array(own[source])),
                        "mult": batch.column("mult").take(pa.array(own[source])),
                        "v": pa.array(vectors, pa.binary()).take(pa.array(source)),
                        "codes": pa.array(marks, pa.binary()).take(pa.array(source)),
                    })

    label, rep = (reps.schema[c].dataType.simpleString() for c in ("label", "rep"))
    return reps.mapInArrow(run, f"label {label}, length int, tab int, bucket int, role int, rep {rep}, mult long, v binary, codes binary")


KEY = ["label", "length", "tab", "bucket"]


def tiled(rows: DataFrame, reps: DataFrame, tables: int, visits: int) -> DataFrame:
    """Rows of hot buckets at every tile they have to meet: role 1 is a resident of an earlier tile."""
    homes = placed(reps, tables, 0).groupBy(*KEY).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles")).where("tiles > 1")
    hot = cut(homes)
    n = hot.count()
    if not n:
        return rows.withColumn("tile", F.lit(0))
    met = rows.join(F.broadcast(hot) if n <= MAX_HOT else hot, KEY, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.when(F.col("role") == 0, F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")).otherwise(F.lit(0))
    spread = met.withColumn("own", own).withColumn("tile", F.explode(F.sequence("own", F.col("tiles") - 1)))
    return spread.withColumn("role", F.when((F.col("role") == 0) & (F.col("tile") != F.col("own")), F.lit(1)).otherwise(F.col("role"))).drop("own", "tiles")


def met(rows: DataFrame, threshold: float, tables: int, visits: int, scalar: type) -> DataFrame:
    """(u, v) forest edges and (u, n) link counts found in the buckets."""
    width = 1 + visits

    def meetings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """pairs x tables*3: both at home in a bucket, a visits b, b visits a."""
        return np.stack((a[:, :, 0] == b[:, :, 0], (a[:, :, 1:] == b[:, :, :1]).any(axis=2), (b[:, :, 1:] == a[:, :, :1]).any(axis=2)), axis=2).reshape(len(a), tables * 3)

    class Rows:
        """Rows of one length as arrays."""

        parts = ("rep", "mult", "role", "v", "codes")

        @classmethod
        def of(cls, batch: pa.RecordBatch) -> Rows:
            own = cls()
            own.rep, own.mult, own.role = (batch.column(c).to_numpy() for c in ("rep", "mult", "role"))
            own.v = unit_rows(np.frombuffer(b"".join(batch.column("v").to_pylist()), dtype=scalar).reshape(len(own.rep), -1))
            own.codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype=code_type(own.v.shape[1])).reshape(len(own.rep), tables, width)
            return own

        def cut(self, a: int, b: int) -> Rows:
            own = Rows()
            for k in self.parts:
                setattr(own, k, getattr(self, k)[a:b])
            return own

        def after(self, first: Rows) -> Rows:
            own = Rows()
            for k in self.parts:
                setattr(own, k, np.concatenate((getattr(first, k), getattr(self, k))))
            return own

    def meet(stored: Rows, other: Rows, tab: int, found: list) -> None:
        same = stored is other
        tall = max(1, CELLS // max(1, len(other.rep)))
        for i in range(0, len(stored.rep), tall):
            x, y = np.nonzero(stored.v[i : i + tall] @ other.v.T >= threshold)
            x += i
            if same:
                keep = x < y
                x, y = x[keep], y[keep]
            if not len(x):
                continue
            u, v = stored.rep[x], other.rep[y]
            low = u < v
            cu, cv = stored.codes[x], other.codes[y]
            first = meetings(np.where(low[:, None, None], cu, cv), np.where(low[:, None, None], cv, cu)).argmax(axis=1)
            now = 3 * tab + np.where(other.role[y] == 2, np.where(low, 2, 1), 0)  # the visitor is `other`: a visits b if a is other
            x, y = x[first == now], y[first == now]
            if len(x):
                u, v = stored.rep[x], other.rep[y]
                found.append((np.concatenate((u, v)), np.concatenate((other.mult[y], stored.mult[x])), *forest(u, v)))

    def told(found: list) -> Iterator[pa.RecordBatch]:
        if found:
            nodes, where = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            n = np.bincount(where, np.concatenate([f[1] for f in found]).astype(float), minlength=len(nodes)).astype(np.int64)
            u, v = (np.concatenate([f[k] for f in found]) for k in (2, 3))
            if len(u):
                u, v = forest(u, v)
            none = pa.nulls(len(nodes), pa.int64()), pa.nulls(len(u), pa.int64())
            found.clear()
            yield pa.RecordBatch.from_arrays([pa.chunked_array([pa.array(a), pa.array(b)]).combine_chunks() for a, b in ((nodes.astype(np.int64), u.astype(np.int64)), (none[0], v.astype(np.int64)), (n, none[1]))], names=["u", "v", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, stored, found, links = None, None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*KEY, "tile")]
            role = batch.column("role").to_numpy()
            edge = np.ones(batch.num_rows, dtype=bool)
            edge[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
            starts = np.flatnonzero(edge)
            turns = np.flatnonzero(np.concatenate(([True], columns[1][1:] != columns[1][:-1])))  # a length each
            turn, whole = -1, None
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
                if (t := int(np.searchsorted(turns, a, "right")) - 1) != turn:
                    turn, base = t, int(turns[t])
                    whole = Rows.of(batch.slice(base, (int(turns[t + 1]) if t + 1 < len(turns) else batch.num_rows) - base))
                now = tuple(c[a] for c in columns)
                if now != key:
                    key, stored = now, None
                tab, homes = int(columns[2][a]), a + int(np.searchsorted(role[a:b], 1))
                if homes > a:
                    own = whole.cut(a - base, homes - base)
                    if homes - a > 1:
                        meet(own, own, tab, found)
                    if stored is not None:  # residents that came in the batch before
                        meet(stored, own, tab, found)
                        own = own.after(stored)
                    stored = own
                if b > homes and stored is not None:
                    meet(stored, whole.cut(homes - base, b - base), tab, found)
                links = sum(len(f[0]) for f in found[-1:]) + links
                if links > 1 << 18:
                    yield from told(found)
                    links = 0
        yield from told(found)

    dealt = rows.repartition(*KEY, "tile").sortWithinPartitions(*KEY, "tile", "role")
    return dealt.mapInArrow(run, "u long, v long, n long")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", tables: int = 6, visits: int = 2
) -> DataFrame:
    """One row per vector: id, n_links, component_id (smallest id reachable), kept."""
    if not 0 <= visits <= 3:
        raise ValueError("visits must be 0 to 3")
    keyed, reps = classes(vectors, id_col, vec_col, label_col)
    rows = tiled(placed(reps, tables, visits), reps, tables, visits)
    found = written(met(rows, threshold, tables, visits, np.float32 if reps.schema["v"].dataType.elementType.simpleString() == "float" else np.float64))
    counts = found.where("n IS NOT NULL").groupBy("u").agg(F.sum("n").alias("n"))
    roots = connected_components(found.where("v IS NOT NULL"), "u", "v")
    named = reps.join(counts, reps["rep"] == counts["u"], "left").join(roots, reps["rep"] == roots["node"], "left")
    done = written(named.select("label", "key", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id")))
    out = keyed.join(done, ["label", "key"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"), (F.col("id") == component).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a
), deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c ON c.a = e.vec_id LEFT JOIN deg d ON d.a = e.vec_id
"""
