"""Line dedup over sharded cuckoo filters and exact reference counts.

A line's key is the line without ASCII white space at both ends and with A-Z lower-cased, as a
128-bit hash. The exact tables hold one posting per (key, document) and per key the number of
documents and the largest document id. Keys of `min_chars` code points or more that `min_docs`
documents hold lose their lines everywhere but in that largest document.

Filters stand before the exact tables and never decide: sharded cuckoo filters over the droppable
keys tell which postings need an exact look. While their size, known from the exact counts, is within
`MAX_FILTER_BYTES`, they are broadcast; then they also tell, while the text is read, which documents can
lose a line at all, and the others never enter a shuffle. Beyond it, filters, droppable keys and postings
meet by shard, each shard in PARTS tasks.

`LineIndex` keeps postings, counts and filters as tables under a path: documents can be inserted and
deleted, and a deletion restores the state before the insertion. A change is written beside the old
state and counts from the moment that its last table, the commit, is there; opening the path again takes
the last commit. One writer at a time.

Defined cases: null and empty texts are one empty line; repeated rows of one id count as one document
and lose the same lines; rows with a null id are never counted and keep all lines; an empty table
gives no rows; other columns pass through `dedup`, which replaces n_lines and n_dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.llm._common import cut, quoted, raw_text, slices, written
from assaylake.llm.cuckoo import CuckooFilter, Shards

SPACE = b" \t\n\r\x0b\x0c"
SHARD_KEYS = 1 << 16
MAX_FILTER_BYTES = 64 << 20
#: Droppable keys (24 bytes each) that are broadcast at most; beyond, postings and keys meet in a shuffle.
MAX_BROADCAST_KEYS = 1_000_000
#: Tasks that share a shard's postings where filters are too large for a broadcast.
PARTS = 16
#: Bytes of a filter for each key, at most: two bytes a slot, half-filled tables after doubling.
KEY_BYTES = 5


def long_key(line: bytes, min_chars: int) -> bytes | None:
    """The hash of a line's key, or None where the key is too short to be dropped."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(keys), dtype=">u8").astype(np.uint64).reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def postings(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(hi, lo, id), once for each key of a row; rows with a null id have none."""
    rows = docs.where(F.col(quoted(id_col)).isNotNull()).select(F.col(quoted(id_col)).alias("id"), raw_text(quoted(text_col)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys: list[bytes] = []
            counts = []
            for text in batch.column("text").to_pylist():
                own = {k for k in (long_key(x, min_chars) for x in (text or b"").split(b"\n")) if k}
                keys += own
                counts.append(len(own))
            hi, lo = halves(keys)
            yield pa.RecordBatch.from_arrays([pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), batch.column("id").take(pa.array(np.repeat(np.arange(len(counts)), counts)))], names=["hi", "lo", "id"])

    return rows.mapInArrow(run, T.StructType([T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType()), T.StructField("id", rows.schema["id"].dataType)]))


def reference_counts(posts: DataFrame) -> DataFrame:
    """(hi, lo, n_docs, last): exact numbers of distinct documents and the largest of their ids."""
    return posts.distinct().groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("last"))


def shard_bits(n_keys: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, n_keys) / SHARD_KEYS))))


def shard_of(bits: int):
    return F.shiftrightunsigned("hi", 64 - bits).cast("long") if bits else F.lit(0).cast("long")


def build_filters(keys: DataFrame, bits: int, room: int = 0) -> DataFrame:
    """(shard, filter) rows; a shard has about SHARD_KEYS keys."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        own = CuckooFilter.of(group["hi"].to_numpy().view(np.uint64), group["lo"].to_numpy().view(np.uint64), room)
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "filter": [own.to_bytes()]})

    return keys.select(shard_of(bits).alias("shard"), "hi", "lo").groupBy("shard").applyInPandas(build, "shard long, filter binary")


def probe(posts: DataFrame, shards) -> DataFrame:
    """The postings whose key a broadcast filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = shards.value.contains(batch.column("hi").to_numpy().view(np.uint64), batch.column("lo").to_numpy().view(np.uint64))
            yield batch.filter(pa.array(hit))

    return posts.mapInArrow(run, posts.schema)


def probe_by_shard(posts: DataFrame, droppable: DataFrame, filters: DataFrame, bits: int) -> DataFrame:
    """(hi, lo, id) of the postings whose key is droppable, but for its last document: a shard's filter first, its exact keys for what passes."""
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    kind = posts.schema["id"].dataType
    each = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    own = shard_of(bits).alias("shard")
    rows = (
        filters.select("shard", each, F.lit(0).alias("role"), none("hi", "long"), none("lo", "long"), none("id", kind), "filter")
        .unionByName(droppable.select(own, each, F.lit(1).alias("role"), "hi", "lo", F.col("last").alias("id"), none("filter", "binary")))
        .unionByName(posts.select(own, F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int").alias("part"), F.lit(2).alias("role"), "hi", "lo", "id", none("filter", "binary")))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard, last = None, None, {}
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("shard", "part", "role")]
            edges = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])))).tolist() if batch.num_rows else []
            for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True) if edges else ():
                now, role, part = (columns[0][a], columns[1][a]), columns[2][a], batch.slice(a, b - a)
                if now != key:
                    key, shard, last = now, None, {}
                if role == 0:
                    shard = CuckooFilter.from_bytes(part.column("filter")[0].as_py())
                    continue
                hi, lo = (part.column(c).to_numpy() for c in ("hi", "lo"))
                if role == 1:
                    last |= zip(zip(hi.tolist(), lo.tolist(), strict=True), part.column("id").to_pylist(), strict=True)
                elif shard is not None:
                    maybe = np.flatnonzero(shard.contains(hi.view(np.uint64), lo.view(np.uint64)))
                    ids = part.column("id").take(pa.array(maybe)).to_pylist()
                    keep = [at for at, x, y, i in zip(maybe.tolist(), hi[maybe].tolist(), lo[maybe].tolist(), ids, strict=True) if last.get((x, y), i) != i]
                    yield part.take(pa.array(keep, pa.int64())).select(["hi", "lo", "id"])

    return rows.repartition("shard", "part").sortWithinPartitions("shard", "part", "role").mapInArrow(run, posts.select("hi", "lo", "id").schema)


def touched(docs: DataFrame, text_col: str, min_chars: int, shards, wanted: bool) -> DataFrame:
    """The rows of which some line's key a filter may hold (wanted), or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            keys: list[bytes] = []
            counts = []
            for text in batch.column(text_col).cast(pa.binary()).to_pylist():
                own = [k for k in (long_key(x, min_chars) for x in (text or b"").split(b"\n")) if k]
                keys += own
                counts.append(len(own))
            hit = np.zeros(len(counts), dtype=bool)
            if keys:
                hit[np.repeat(np.arange(len(counts)), counts)[shards.value.contains(*halves(keys))]] = True
            yield batch.filter(pa.array(hit == wanted))

    return docs.mapInArrow(run, docs.schema)


def apply_counts(docs: DataFrame, posts: DataFrame, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """`docs` without the lines that the exact tables condemn, and n_lines, n_dropped of each row."""
    spark = docs.sparkSession
    droppable = cut(counts.where(F.col("n_docs") >= min_docs).select("hi", "lo", "last"))
    n = droppable.count()
    base = docs.drop("n_lines", "n_dropped")
    own_id, own_keys = (next(x for i in range(len(base.columns) + 1) if (x := f"{n}{i}") not in base.columns) for n in ("doomed_id_", "doomed_keys_"))
    calm, open_docs = None, base
    bits = shard_bits(n)
    filters = build_filters(droppable, bits)
    if n * KEY_BYTES <= MAX_FILTER_BYTES:
        rows = filters.collect()  # n * KEY_BYTES at most
        shards = spark.sparkContext.broadcast(Shards(bits, {r["shard"]: CuckooFilter.from_bytes(bytes(r["filter"])) for r in rows}))
        calm = touched(base, text_col, min_chars, shards, wanted=False)
        open_docs = touched(base, text_col, min_chars, shards, wanted=True)
        lost = probe(posts, shards).join(F.broadcast(droppable) if n <= MAX_BROADCAST_KEYS else droppable, ["hi", "lo"]).where("id != last")
    else:
        lost = probe_by_shard(posts, droppable, cut(filters), bits)
    doomed = lost.select("hi", "lo", "id").distinct().groupBy(F.col("id").alias(own_id)).agg(F.collect_list(F.struct("hi", "lo")).alias(own_keys))
    met = open_docs.join(doomed, open_docs[quoted(id_col)] == doomed[own_id], "left").drop(own_id)
    names = base.columns
    schema = T.StructType([*base.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            gone = batch.column(own_keys)
            offsets, bad = gone.offsets.to_numpy(), gone.is_null().to_numpy(zero_copy_only=False)
            pairs = np.stack([gone.values.field(k).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for k in ("hi", "lo")], axis=1).astype(">u8")
            texts, n_lines, n_dropped = [], [], []
            for i, text in enumerate(batch.column(text_col).cast(pa.binary()).to_pylist()):
                lines = (text or b"").split(b"\n")
                if bad[i]:
                    kept = lines
                else:
                    out = {x.tobytes() for x in pairs[offsets[i] : offsets[i + 1]]}
                    kept = [x for x in lines if long_key(x, min_chars) not in out]
                texts.append(b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.binary()).cast(pa.string()) if k == text_col else batch.column(k) for k in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[f.name for f in schema.fields])

    done = met.mapInArrow(rewrite, schema)
    if calm is None:
        return done
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return done.unionByName(calm.withColumn(text_col, text).withColumns({"n_lines": lines.cast("long"), "n_dropped": F.lit(0).cast("long")}))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One batch against an empty index: `docs` with the lines that stay, n_lines and n_dropped."""
    posts = written(postings(docs, id_col, text_col, min_chars))
    return apply_counts(docs, posts, reference_counts(posts), id_col, text_col, min_chars, min_docs)


class LineIndex:
    """Reversible state under `path`: postings, counts and filters; see above for what a commit is.

    A batch's keys first meet the filter of their shard; only those it may hold are joined with the
    exact tables, the others are new for certain. An insertion adds its postings as a table of their own,
    and to each filter the keys that are new; only a filter that has no room is built again, from the
    counts of its shard. The number of shards is set for `expected_keys` and grows fourfold beyond it.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", min_chars: int = 40, expected_keys: int = 0):
        self.spark, self.path, self.min_chars = spark, path, min_chars
        self.schemas = {"postings": f"hi long, lo long, id {id_type}", "counts": f"hi long, lo long, n_docs long, last {id_type}", "filters": "shard long, filter binary"}
        self.generation, self.bits, self.places = 0, shard_bits(expected_keys), {k: [] for k in self.schemas}
        if commits := self._commits():
            self.generation = max(commits)
            last = spark.read.parquet(self._at(self.generation, "commit")).first()
            if (last["id_type"], last["min_chars"]) != (id_type, min_chars):
                raise ValueError(f"the index was made for ids of type {last['id_type']} and lines of {last['min_chars']} characters")
            self.bits, self.places = last["bits"], {k: list(last[k]) for k in self.schemas}

    def _at(self, generation: int, name: str) -> str:
        return f"{self.path}/{generation:012d}/{name}"

    def _commits(self) -> list[int]:
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/*/commit/_SUCCESS")
        found = where.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(where)
        return [int(x.getPath().getParent().getParent().getName()) for x in found or ()]

    def table(self, name: str) -> DataFrame:
        places = self.places[name]
        return self.spark.read.schema(self.schemas[name]).parquet(*places) if places else self.spark.createDataFrame([], self.schemas[name])

    def _commit(self, added: DataFrame | None = None, bits: int | None = None, **tables: DataFrame) -> None:
        """Writes tables in place of the old ones, and `added` to the postings; until the last write is done this object stays as it was."""
        bits = self.bits if bits is None else bits
        now, at = dict(self.places), self.generation + 1
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(self._at(at, name))  # what is there was never committed
            now[name] = [self._at(at, name)]
        if added is not None:
            added.write.mode("overwrite").parquet(self._at(at, "postings"))
            now["postings"] = [*now["postings"], self._at(at, "postings")]
        id_type = self.schemas["postings"].rpartition(" ")[2]
        row = (bits, self.min_chars, id_type, *(now[k] for k in self.schemas))
        self.spark.createDataFrame([row], "bits int, min_chars int, id_type string, " + ", ".join(f"{k} array<string>" for k in self.schemas)).coalesce(1).write.mode("overwrite").parquet(self._at(at, "commit"))
        self.generation, self.places, self.bits = at, now, bits

    def _maybe(self, keys: DataFrame) -> DataFrame:
        """Distinct (hi, lo) keys with `maybe`: whether their shard's filter may hold them.

        A batch that is large beside the index is dealt to several groups of a shard, each with its filter.
        """
        if not self.places["filters"]:
            return keys.withColumn("maybe", F.lit(False))
        parts = 1 << max(0, shard_bits(keys.count()) - self.bits)

        def look(own: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            hit = np.zeros(len(own), dtype=bool)
            if len(own) and len(filters):
                hit = CuckooFilter.from_bytes(bytes(filters["filter"].iloc[0])).contains(own["hi"].to_numpy().view(np.uint64), own["lo"].to_numpy().view(np.uint64))
            return own[["hi", "lo"]].assign(maybe=hit)

        own = keys.select(shard_of(self.bits).alias("shard"), F.pmod(F.xxhash64("hi", "lo"), F.lit(parts)).cast("int").alias("part"), "hi", "lo").groupBy("shard", "part")
        filters = self.table("filters").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).groupBy("shard", "part")
        return own.cogroup(filters).applyInPandas(look, "hi long, lo long, maybe boolean")

    def _filters(self, counts: DataFrame, new: DataFrame) -> tuple[int, DataFrame]:
        """The bits of shards and the filters of all counted keys, of which `new` are not in the filters yet."""
        n = counts.count()
        if n > 4 * SHARD_KEYS << self.bits or not self.places["filters"]:
            bits = max(self.bits, shard_bits(n))
            return bits, build_filters(counts, bits)

        def grow(filters: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            if not len(own):
                return filters[["shard", "filter"]]
            hi, lo = (own[c].to_numpy().view(np.uint64) for c in ("hi", "lo"))
            made = None
            if len(filters):
                made = CuckooFilter.from_bytes(bytes(filters["filter"].iloc[0]))
                try:
                    made.insert(hi, lo)
                except OverflowError:
                    return pd.DataFrame({"shard": [own["shard"].iloc[0]], "filter": [None]})
            made = made or CuckooFilter.of(hi, lo, len(hi))
            return pd.DataFrame({"shard": [own["shard"].iloc[0]], "filter": [made.to_bytes()]})

        fresh = new.select(shard_of(self.bits).alias("shard"), "hi", "lo").groupBy("shard")
        grown = written(self.table("filters").groupBy("shard").cogroup(fresh).applyInPandas(grow, self.schemas["filters"]))
        full = grown.where("filter IS NULL").select(F.col("shard").alias("full"))
        again = counts.join(F.broadcast(full), shard_of(self.bits) == F.col("full"), "left_semi")  # as many rows as there are shards at most
        return self.bits, grown.where("filter IS NOT NULL").unionByName(build_filters(again, self.bits, SHARD_KEYS // 2))

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Adds documents; an id that is there already gets the new keys besides its old ones, and nothing twice."""
        new = written(postings(docs, id_col, text_col, self.min_chars).distinct())
        marked = written(self._maybe(written(new.select("hi", "lo").distinct())))
        known = new.join(marked.where("maybe"), ["hi", "lo"], "left_semi").join(self.table("postings"), ["hi", "lo", "id"], "left_anti")
        fresh = written(known.unionByName(new.join(marked.where("NOT maybe"), ["hi", "lo"], "left_semi")))
        added = written(reference_counts(fresh).withColumnsRenamed({"n_docs": "more", "last": "newest"}))
        old = self.table("counts")
        counts = written(old.join(added, ["hi", "lo"], "full").select("hi", "lo", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("last", "newest").alias("last")))
        unseen = added.select("hi", "lo").join(old, ["hi", "lo"], "left_anti")
        bits, filters = self._filters(counts, unseen)
        self._commit(added=fresh, bits=bits, counts=counts, filters=filters)

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Takes documents out; counts of their keys are taken anew from the postings that stay."""
        all_posts = self.table("postings")
        gone = written(all_posts.join(ids.select(F.col(quoted(id_col)).alias("id")).distinct(), "id", "left_semi").select("hi", "lo", "id"))
        left = written(all_posts.join(gone, ["hi", "lo", "id"], "left_anti"))
        keys = gone.select("hi", "lo").distinct()
        anew = reference_counts(left.join(keys, ["hi", "lo"], "left_semi"))
        dead = written(keys.join(anew, ["hi", "lo"], "left_anti"))
        counts = self.table("counts").join(keys, ["hi", "lo"], "left_anti").unionByName(anew)

        def strike(filters: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            out = CuckooFilter.from_bytes(bytes(filters["filter"].iloc[0]))
            out.delete(own["hi"].to_numpy().view(np.uint64), own["lo"].to_numpy().view(np.uint64))
            return filters.assign(filter=[out.to_bytes()])

        shards = dead.select(shard_of(self.bits).alias("shard"), "hi", "lo").groupBy("shard")
        filters = self.table("filters").groupBy("shard").cogroup(shards).applyInPandas(strike, self.schemas["filters"])
        self._commit(postings=left, counts=counts, filters=filters)

    def apply(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 5) -> DataFrame:
        """`docs`, all of them inserted before, without the lines that the index condemns."""
        own = self.table("postings").join(docs.select(F.col(quoted(id_col)).alias("id")).distinct(), "id", "left_semi").select("hi", "lo", "id")
        return apply_counts(docs, own, self.table("counts"), id_col, text_col, self.min_chars, min_docs)


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, ordinal, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS ordinal FROM documents)
), held AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.ordinal, l.line, h.key IS NOT NULL AND l.doc_id <> h.last AS dropped FROM lines l LEFT JOIN held h ON l.key = h.key
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY ordinal) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
