"""SimHash near-duplicates: fingerprints, tiled exact Hamming comparison, connected groups.

Words are runs of other bytes than ASCII white space after A-Z are lower-cased; all shingles of a text
count, repeats included (fewer words than a shingle: the whole sequence; none: fingerprint zero).

Comparison is exact. Distinct fingerprints are sorted into classes by the population counts of four
16-bit blocks (at most 17^4 classes, so their sizes can be broadcast), large classes into tiles. Two
fingerprints within the radius differ in these counts by the radius at most, so only tiles of such
neighbouring classes meet; numpy compares them with exclusive-or and bit counts in blocks of fixed
size. A pair of tiles gives back a spanning forest of its links, never all its pairs: copies cannot
blow up the result, and no two linked fingerprints end up in different components.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; repeated
rows and equal fingerprints are one class, each row is returned; null ids take part, and a component
without any other id has a null component_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm._common import cut, quoted, raw_text, slices, written
from assaylake.operators.graph import connected_components

BLOCKS, BLOCK_BITS = 4, 16
CLASSES = (BLOCK_BITS + 1) ** BLOCKS
#: Fingerprints of a tile, at most by expectation: a class beyond it is dealt to several tiles by a hash.
TILE = 1 << 14
#: Compared pairs held at once, and the longer side of their block.
CELLS, WIDE = 1 << 16, 1 << 12
#: Shingles whose bits are unpacked at once.
UNPACKED = 1 << 15


def shingle_hashes(text: bytes | None, size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle, in text order."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words), seed)], dtype=np.uint64)
    line = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = itertools.chain((0,), (e + 1 for e in ends))
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, ends[size - 1 :], strict=False)), dtype=np.uint64, count=len(words) - size + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as an unsigned 64-bit number."""
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), UNPACKED):
        bits = np.unpackbits(hashes[at : at + UNPACKED].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big") if len(hashes) else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) with the fingerprint's bits as a signed long."""
    rows = docs.select(F.col(quoted(id_col)).alias("id"), raw_text(quoted(text_col)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.fromiter((fingerprint(shingle_hashes(x, shingle)) for x in batch.column("text").to_pylist()), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], names=["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def class_of(fp: Column) -> Column:
    counts = [F.bit_count(F.shiftrightunsigned(fp, BLOCK_BITS * b).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))) for b in range(BLOCKS)]
    return sum((c * (BLOCK_BITS + 1) ** b for b, c in enumerate(counts)), F.lit(0)).cast("int")


def neighbours(radius: int) -> np.ndarray:
    """Differences of block counts within the radius, of which the first non-zero one is positive."""
    span = range(-radius, radius + 1)
    return np.array([d for d in itertools.product(span, repeat=BLOCKS) if sum(map(abs, d)) <= radius and next((x for x in d if x), 0) > 0], dtype=np.int64).reshape(-1, BLOCKS)


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that span the components of the given links."""
    nodes, flat = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs that differ by `radius` bits at most, block by block; a block fits a core's cache."""
    wide = max(1, min(len(b), WIDE))
    tall = max(1, CELLS // wide)
    both, count = np.empty((tall, wide), dtype=np.uint64), np.empty((tall, wide), dtype=np.uint8)
    for j in range(0, len(b), wide):
        right = b[None, j : j + wide]
        for i in range(0, len(a), tall):
            left = a[i : i + tall, None]
            x, n = both[: len(left), : right.shape[1]], count[: len(left), : right.shape[1]]
            np.bitwise_xor(left, right, out=x)
            np.bitwise_count(x, out=n)
            hit = np.flatnonzero(n <= radius)
            if len(hit):
                yield i + hit // right.shape[1], j + hit % right.shape[1]


def compare(stored: np.ndarray, probes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between two arrays of fingerprints; equal ones are no link."""
    us, vs = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for x, y in close_pairs(stored, probes, radius):
        u, v = forest(stored[x], probes[y])
        us.append(u)
        vs.append(v)
    u, v = np.concatenate(us), np.concatenate(vs)
    return forest(u, v) if len(u) else (u, v)


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """(u, v) edges that span all links of the distinct fingerprints in column fp."""
    spark = fps.sparkSession
    classed = fps.select("fp", class_of(F.col("fp")).alias("class"))
    sizes = classed.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))  # at most CLASSES rows
    tiles_of = np.zeros(CLASSES, dtype=np.int32)
    for row in sizes.collect():
        tiles_of[row["class"]] = row["tiles"]
    many = spark.createDataFrame([(int(c), int(tiles_of[c])) for c in np.flatnonzero(tiles_of > 1)], "class int, tiles int")  # at most CLASSES rows
    tile = F.pmod(F.xxhash64("fp"), F.coalesce("tiles", F.lit(1))).cast("int").alias("tile")
    tiles = classed.join(F.broadcast(many), "class", "left").groupBy("class", tile).agg(F.collect_list("fp").alias("fps"))
    shared = spark.sparkContext.broadcast((tiles_of, neighbours(radius)))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each tile at its own place, and as a visitor at the later tiles of its class and at all tiles of half the neighbouring classes."""
        counts, steps = shared.value
        for batch in batches:
            source, klass, tile, role = [], [], [], []
            for i, (c, t) in enumerate(zip(batch.column("class").to_pylist(), batch.column("tile").to_pylist(), strict=True)):
                at = np.array([c // (BLOCK_BITS + 1) ** b % (BLOCK_BITS + 1) for b in range(BLOCKS)]) + steps
                near = at[((at >= 0) & (at <= BLOCK_BITS)).all(axis=1)] @ (BLOCK_BITS + 1) ** np.arange(BLOCKS)
                own = [(c, x, int(x != t)) for x in range(t, counts[c])] + [(n, x, 1) for n in near[counts[near] > 0].tolist() for x in range(counts[n])]
                source += [i] * len(own)
                for lst, values in zip((klass, tile, role), zip(*own, strict=True), strict=True):
                    lst += values
                if len(source) >= 4096:
                    yield placed(batch, source, klass, tile, role)
                    source, klass, tile, role = [], [], [], []
            if source:
                yield placed(batch, source, klass, tile, role)

    def placed(batch: pa.RecordBatch, source: list, klass: list, tile: list, role: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(klass, pa.int32()), pa.array(tile, pa.int32()), pa.array(role, pa.int32()), batch.column("fps").take(pa.array(source))], names=["class", "tile", "role", "fps"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, stored, waiting, held = None, np.zeros(0, np.uint64), [], 0
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def done() -> None:
            nonlocal held
            if waiting and len(stored):
                found.append(compare(stored, np.concatenate(waiting), radius))
            waiting.clear()
            held = 0

        for batch in batches:
            column = batch.column("fps")
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
            for i, now in enumerate(zip(batch.column("class").to_pylist(), batch.column("tile").to_pylist(), batch.column("role").to_pylist(), strict=True)):
                own = values[offsets[i] : offsets[i + 1]]
                if now[:2] != key:
                    done()
                    key, stored = now[:2], np.zeros(0, np.uint64)
                if now[2] == 0:
                    stored = own.copy()
                    found.append(compare(stored, stored, radius))
                else:
                    waiting.append(own.copy())
                    held += len(own)
                    if held >= 1 << 16:
                        done()
            if found:
                u, v = (np.concatenate(x) for x in zip(*found, strict=True))
                found.clear()
                if len(u):
                    yield pa.RecordBatch.from_pydict({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})
        done()
        for u, v in found:
            yield pa.RecordBatch.from_pydict({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    met = tiles.mapInArrow(visits, "class int, tile int, role int, fps array<long>").repartition("class", "tile").sortWithinPartitions("class", "tile", "role")
    return met.mapInArrow(meet, "u long, v long")


def components(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint of (id, fp) rows: the smallest id reachable."""
    reps = written(prints.groupBy("fp").agg(F.min("id").alias("least")))
    roots = connected_components(links(reps.select("fp"), radius), "u", "v")
    member = cut(reps.join(roots, reps["fp"] == roots["node"]).select("fp", "least", "root"))
    low = cut(member.groupBy("root").agg(F.min("least").alias("component_id")))
    named = cut(member.join(low, "root").select("fp", "component_id"))
    return cut(reps.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id for every row."""
    prints = written(fingerprints(docs, id_col, text_col, shingle))
    named = components(prints, radius)
    out = prints.join(named, "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
