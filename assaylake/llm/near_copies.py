"""SimHash near-dedup of documents by shingle similarity: one document of each group stays.

Candidates: 256-bit fingerprints over distinct shingles, compared exactly in tiles by numpy: the first
word by exclusive-or and bit counts, the other three only where it is close enough. Tiles hold sets of
about one size, and pairs of tiles whose sizes (the population counts of the sets as bit vectors) differ
beyond what the similarity allows are skipped: a set of n shingles can only be similar to sets of
similarity * n to n / similarity. The radius is set so that a pair at the wanted similarity is missed
about once in a thousand and unrelated pairs do not occur. That estimate does not hold for few shingles,
so texts of SHORT distinct shingles or fewer meet by an exact prefix join instead: of two sets that are
similar enough, the rarest few shingles of both have one in common. Verification: the documents of a
candidate group meet again in tiles with their whole sets of shingles, and only pairs whose Jaccard
similarity reaches the threshold link. Both steps hand on spanning forests, so groups of thousands of
copies never become lists of pairs. The number of compared fingerprint pairs still grows with the square
of the number of different documents of one size; see the README for what that costs.

Defined cases: null and empty texts are copies of each other; texts of fewer words than a shingle are
one shingle; equal sets of shingles are copies, equal fingerprints of different sets only candidates;
the smallest id of a group stays (ids are whole numbers); repeated rows of an id stay or go together;
rows with a null id stay; an empty table gives no rows; all columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.llm._common import cut, quoted, raw_text, slices, written
from assaylake.operators.graph import connected_components
from assaylake.llm.simhash import close_pairs, fingerprint, forest, shingle_hashes

WORDS = 4
NAMES = [f"w{k}" for k in range(WORDS)]
#: 128 bits over the sorted distinct shingles: what Jaccard similarity sees of a text.
CONTENT = ["c0", "c1"]
#: Fingerprints of a tile at most by expectation, and parts of a tile that travel as one row each.
TILE, PARTS = 1 << 16, 16
#: Classes of sizes for each step of the similarity: sets of classes further apart than this are never similar enough.
FINE = 4
#: Documents of a tile of a candidate group; every pair of tiles is a task's key of its own.
GROUP_TILE = 256
#: Rows of ids that are broadcast at most; beyond, both sides are shuffled.
MAX_BROADCAST_IDS = 1_000_000
#: Distinct shingles up to which texts meet exactly. Of larger ones, the tie rule of the bits makes at most 0.0011 of the pairs at 0.8 be missed.
SHORT = 64
#: Standard deviations by which the radius lies above the distance to expect at the threshold.
MARGIN = 3.3


def radii(similarity: float) -> tuple[int, int]:
    """Allowed bits of difference in the first word and in all words for a Jaccard similarity."""
    p = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    return tuple(min(bits, math.ceil(bits * p + extra * math.sqrt(bits * p * (1 - p)))) for bits, extra in ((64, MARGIN + 0.5), (64 * WORDS, MARGIN)))


def words_of(hashes: np.ndarray) -> list[int]:
    """The first word votes with the hashes, the others with hashes of these."""
    out = [fingerprint(hashes)]
    for k in range(1, WORDS):
        x = hashes + np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(fingerprint(x ^ (x >> np.uint64(31))))
    return out


def content(own: np.ndarray) -> np.ndarray:
    """CONTENT of a sorted set of hashes."""
    return np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), dtype=np.int64)


def small(df: DataFrame) -> DataFrame:
    """`df` of ids, marked for a broadcast if it is known to be small enough."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_IDS else df


def prints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    rows = docs.where(F.col(quoted(id_col)).isNotNull()).select(F.col(quoted(id_col)).cast("long").alias("id"), raw_text(quoted(text_col)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.zeros((batch.num_rows, WORDS + len(CONTENT) + 1), dtype=np.int64)
            for i, x in enumerate(batch.column("text").to_pylist()):
                own = np.unique(shingle_hashes(x, shingle))
                found[i, :WORDS] = np.array(words_of(own), dtype=np.uint64).view(np.int64)
                found[i, WORDS:-1] = content(own)
                found[i, -1] = len(own)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(found[:, k].copy()) for k in range(found.shape[1]))], names=["id", *NAMES, *CONTENT, "n"])

    return rows.mapInArrow(run, "id long, " + ", ".join(f"{n} long" for n in [*NAMES, *CONTENT, "n"]))


def size_class(n, similarity: float):
    """Number of the class of sets of n shingles."""
    return F.floor(F.log(n) / (math.log(1 / similarity) * (1 + 1e-9) / FINE)).cast("int")


def tiles_of_classes(sizes: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """(class, first tile, tiles, first and last tile that it meets) for the numbers of sets in each class; tiles are numbered by class."""
    own, at = {}, 0
    for c in sorted(sizes):
        own[c] = (at, -(-sizes[c] // TILE))
        at += own[c][1]
    out = []
    for c, (first, n) in own.items():
        near = [own[x] for x in range(c - FINE, c + FINE + 1) if x in own]
        out.append((c, first, n, near[0][0], near[-1][0] + near[-1][1] - 1))
    return out


def candidate_links(reps: DataFrame, near: int, far: int, similarity: float) -> DataFrame:
    """Forest edges (u, v) between the ids of reps (rep, n, w0..) of sizes that can be similar and whose fingerprints differ by `far` bits at most."""
    able = reps.where(F.col("n") > math.floor(SHORT * similarity)).select("rep", "n", *NAMES, size_class(F.col("n"), similarity).alias("class"))
    sizes = {r["class"]: r["count"] for r in able.groupBy("class").count().collect()}  # a few hundred: the logarithm of the longest text
    near_tiles = reps.sparkSession.createDataFrame(tiles_of_classes(sizes), "class int, first int, tiles int, low int, high int")
    dealt = able.join(F.broadcast(near_tiles), "class").withColumn("tile", F.col("first") + F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")).withColumn("part", F.pmod(F.xxhash64(F.lit(7), "rep"), F.lit(PARTS)).cast("int"))
    tiles = dealt.groupBy("tile", "part", "low", "high").agg(F.collect_list(F.struct("rep", *NAMES)).alias("own"))
    pairs = F.transform(F.sequence("low", "high"), lambda o: F.struct(F.least(o, F.col("tile")).alias("i"), F.greatest(o, F.col("tile")).alias("j"), F.when(F.col("tile") <= o, 0).otherwise(1).alias("role")))
    spread = tiles.select(F.explode(pairs).alias("p"), "own").select("p.i", "p.j", "p.role", "own")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, words = None, None, None
        us: list[np.ndarray] = []
        vs: list[np.ndarray] = []

        def compare(a_ids, a, b_ids, b, same: bool) -> None:
            for x, y in close_pairs(a[0], b[0], near):
                if same:
                    keep = a_ids[x] < b_ids[y]
                    x, y = x[keep], y[keep]
                close = np.bitwise_count(a[:, x] ^ b[:, y]).sum(axis=0, dtype=np.int64) <= far
                if close.any():
                    u, v = forest(a_ids[x[close]], b_ids[y[close]])
                    us.append(u)
                    vs.append(v)

        for batch in batches:
            column = batch.column("own")
            offsets = column.offsets.to_numpy()
            flat = [column.values.field(c).to_numpy() for c in ("rep", *NAMES)]
            for row, now in enumerate(zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("role").to_pylist(), strict=True)):
                own = slice(offsets[row], offsets[row + 1])
                new_ids, new = flat[0][own].copy(), np.stack([f[own] for f in flat[1:]]).view(np.uint64)
                if now[:2] != key:
                    key, ids, words = now[:2], np.zeros(0, np.int64), np.zeros((WORDS, 0), np.uint64)
                if now[2] == 0:
                    if now[0] == now[1]:
                        compare(ids, words, new_ids, new, False)
                        compare(new_ids, new, new_ids, new, True)
                    ids, words = np.concatenate((ids, new_ids)), np.concatenate((words, new), axis=1)
                else:
                    compare(ids, words, new_ids, new, False)
            if us:
                u, v = forest(np.concatenate(us), np.concatenate(vs))
                us.clear(), vs.clear()
                yield pa.RecordBatch.from_pydict({"u": pa.array(u), "v": pa.array(v)})

    return spread.repartition("i", "j").sortWithinPartitions("i", "j", "role").mapInArrow(meet, "u long, v long")


def short_links(docs: DataFrame, reps: DataFrame, similarity: float, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Edges (u, v) that connect all reps (rep, n) of SHORT shingles at most whose sets can be similar enough.

    Shingles are ordered by the number of short texts that hold them, then by hash. A set of n has at least
    ceil(similarity * n) shingles in common with a similar one, so both hold one of the other's first
    n - ceil(similarity * n) + 1. Texts that share such a shingle link to the smallest id that has it.
    """
    wanted = reps.where(F.col("n").between(1, SHORT)).select(F.col("rep").alias("id"))
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), raw_text(quoted(text_col)).alias("text")).join(small(wanted), "id").select("id", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [np.unique(shingle_hashes(x, shingle)) for x in batch.column("text").to_pylist()]
            own = [x if len(x) <= SHORT else x[:0] for x in found]  # another row of the id
            sizes = [len(x) for x in own]
            c0 = np.array([content(x)[0] for x in own], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(np.repeat(np.arange(len(own)), sizes))), pa.array(np.repeat(c0, sizes)), pa.array(np.concatenate(own).view(np.int64))], names=["id", "c0", "h"])

    held = written(rows.mapInArrow(sets, "id long, c0 long, h long").distinct())
    often = cut(held.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    ranked = held.join(small(often), "h").groupBy("id", "c0").agg(F.array_sort(F.collect_list(F.struct("times", "h"))).alias("own"))
    sizes = held.groupBy("id", "c0").agg(F.count(F.lit(1)).alias("n"))
    # Shingles that no other text holds come first and link nothing: they only take their places of the prefix.
    left = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1 - (F.col("n") - F.size("own"))
    first = cut(ranked.join(sizes, ["id", "c0"]).where(left > 0).select("id", F.explode(F.slice("own", F.lit(1), left.cast("int"))["h"]).alias("h")))
    least = cut(first.groupBy("h").agg(F.min("id").alias("v")))
    return first.join(small(least), "h").where("id != v").select(F.col("id").alias("u"), "v").distinct()


def verified_links(docs: DataFrame, groups: DataFrame, similarity: float, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Forest edges (u, v) between documents of one candidate group (node, root) whose shingle sets are similar enough."""
    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / GROUP_TILE).cast("int").alias("tiles"))
    wanted = cut(groups.join(sizes, "root"))
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("node"), raw_text(quoted(text_col)).alias("text")).join(small(wanted), "node")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [np.unique(shingle_hashes(x, shingle)).view(np.int64) for x in batch.column("text").to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("root"), batch.column("tiles"), batch.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))], names=["root", "tiles", "node", "own"])

    made = rows.select("node", "text", "root", "tiles").mapInArrow(sets, "root long, tiles int, node long, own array<long>")
    home = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    other = F.sequence(F.lit(0), F.col("tiles") - 1)
    pairs = F.transform(other, lambda o: F.struct(F.least(o, F.col("home")).alias("i"), F.greatest(o, F.col("home")).alias("j"), F.when(F.col("home") <= o, 0).otherwise(1).alias("role")))
    spread = made.withColumn("home", home).select("root", F.explode(pairs).alias("p"), "node", "own").select("root", "p.i", "p.j", "p.role", "node", "own")

    class Tile:
        """Documents with their hashes in one sorted array."""

        def __init__(self):
            self.nodes, self.sets, self.ready = [], [], False

        def add(self, node: int, own: np.ndarray) -> None:
            self.nodes.append(node)
            self.sets.append(own)
            self.ready = False

        def prepare(self) -> None:
            owner = np.repeat(np.arange(len(self.sets)), [len(x) for x in self.sets])
            flat = np.concatenate(self.sets)
            order = np.argsort(flat, kind="stable")
            self.flat, self.owner, self.sizes, self.ids = flat[order], owner[order], np.array([len(x) for x in self.sets]), np.array(self.nodes, dtype=np.int64)
            self.ready = True

        def similar(self, own: np.ndarray) -> np.ndarray:
            """Places of the documents that are similar enough to the set."""
            if not self.ready:
                self.prepare()
            a, b = np.searchsorted(self.flat, own, "left"), np.searchsorted(self.flat, own, "right")
            n = b - a
            at = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            common = np.bincount(self.owner[at], minlength=len(self.sizes))
            return np.flatnonzero(common >= similarity * (self.sizes + len(own) - common))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tile = None, Tile()
        us: list[np.ndarray] = []
        vs: list[np.ndarray] = []

        def link(node: int, places: np.ndarray) -> None:
            others = tile.ids[places]
            others = others[others != node]
            us.append(np.full(len(others), node))
            vs.append(others)

        def close() -> None:
            """A tile that meets itself does so when all of it is there."""
            if key is not None and key[1] == key[2]:
                for node, own in zip(tile.nodes, tile.sets, strict=True):
                    link(node, tile.similar(own))

        def told() -> Iterator[pa.RecordBatch]:
            if us and len(u := np.concatenate(us)):
                u, v = forest(u, np.concatenate(vs))
                yield pa.RecordBatch.from_pydict({"u": pa.array(u), "v": pa.array(v)})
            us.clear(), vs.clear()

        for batch in batches:
            column = batch.column("own")
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
            for row, (root, i, j, role, node) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j", "role", "node")), strict=True)):
                own = values[offsets[row] : offsets[row + 1]].copy()
                if (root, i, j) != key:
                    close()
                    key, tile = (root, i, j), Tile()
                if role == 0:
                    tile.add(node, own)
                elif tile.nodes:
                    link(node, tile.similar(own))
                if len(us) > 512:
                    yield from told()
            yield from told()
        close()
        yield from told()

    return spread.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "role").mapInArrow(meet, "u long, v long")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(rep, root): the smallest id of each distinct set of shingles and the smallest id of its group."""
    found = prints(docs, id_col, text_col, shingle)
    reps = written(found.groupBy(*CONTENT).agg(F.min("id").alias("rep"), *[F.first(n).alias(n) for n in [*NAMES, "n"]]))
    links = candidate_links(reps.select("rep", "n", *NAMES), *radii(similarity), similarity).unionByName(short_links(docs, reps, similarity, id_col, text_col, shingle))
    maybe = cut(connected_components(links, "u", "v"))
    roots = connected_components(verified_links(docs, maybe, similarity, id_col, text_col, shingle), "u", "v")
    return cut(reps.select("rep").join(roots, reps["rep"] == roots["node"], "left").select("rep", F.coalesce("root", "rep").alias("root")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its group."""
    kept = groups(docs, id_col, text_col, shingle, similarity).where("rep = root").select(F.col("rep").alias("__kept"))
    named = docs.join(small(kept), docs[quoted(id_col)].cast("long") == kept["__kept"], "left_semi")
    return named.unionByName(docs.where(F.col(quoted(id_col)).isNull()))
