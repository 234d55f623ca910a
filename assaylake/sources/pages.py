"""Cached search pages and acquired documents, checked against their receipts; fetching itself is the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable_pages(requests: DataFrame, receipts: DataFrame, payloads: DataFrame, now: Column, ttl_days: int = 30) -> DataFrame:
    """`requests` (url_sha256, contract) with source and payload: a cached page of the same contract that is young enough and still has its hash,
    a terminal failure to be replayed, or what has to be fetched.

    receipts: url_sha256, contract, status, fetched_at, payload_sha256; payloads: payload_sha256, payload.
    """
    newest = receipts.groupBy("url_sha256", "contract").agg(F.max_by(F.struct("status", "fetched_at", "payload_sha256"), "fetched_at").alias("_r"))
    held = payloads.select("payload_sha256", "payload", (F.sha2(F.col("payload").cast("binary"), 256) == F.col("payload_sha256")).alias("_ok"))
    met = requests.join(newest, ["url_sha256", "contract"], "left").join(held, F.col("_r.payload_sha256") == held["payload_sha256"], "left")
    young = F.col("_r.fetched_at") >= now - F.expr(f"INTERVAL {int(ttl_days)} DAYS")
    source = F.when((F.col("_r.status") == "OK") & young & F.coalesce("_ok", F.lit(False)), "CACHE").when(F.col("_r.status") == "TERMINAL_FAILURE", "REPLAYED_FAILURE").otherwise("FETCH")
    return met.select(*requests.columns, source.alias("source"), F.when(source == "CACHE", F.col("payload")).alias("payload"))


def checked_documents(files: DataFrame, most_bytes: int = 100 << 20) -> DataFrame:
    """(path, sha256, bytes, status) of (path, content) rows: size and the mark of a PDF; a document's name is its hash."""
    size = F.length("content")
    status = F.when(size > most_bytes, "TOO_LARGE").when(F.substring("content", 1, 5) != F.lit(b"%PDF-"), "NOT_A_PDF").otherwise("ACCEPTED")
    return files.select("path", F.sha2("content", 256).alias("sha256"), size.cast("long").alias("bytes"), status.alias("status"))


def body_free(rows: DataFrame, ids: list[str], keep: list[str]) -> DataFrame:
    """Hashed ids and allowed columns only."""
    return rows.select(*[F.sha2(F.col(c).cast("string").cast("binary"), 256).alias(f"{c}_sha256") for c in ids], *keep)


def leaks(rows: DataFrame) -> DataFrame:
    """Rows of which a text column holds a link or a DOI."""
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    bad = F.lit(False)
    for c in texts:
        bad = bad | F.coalesce(F.col(c).rlike(r"(?i)https?://|\b10\.[0-9]{4,9}/"), F.lit(False))
    return rows.where(bad)


def source_inventory(kinds: dict[str, DataFrame]) -> DataFrame:
    """(source_id, document, kind, page, text) of several kinds of sources; the id is a hash of what identifies a block."""
    parts = None
    for kind, df in kinds.items():
        key = F.concat_ws("|", "document", F.lit(kind), F.col("page").cast("string"), F.col("text"))
        one = df.select(F.substr(F.sha2(key.cast("binary"), 256), F.lit(1), F.lit(24)).alias("source_id"), "document", F.lit(kind).alias("kind"), "page", "text")
        parts = one if parts is None else parts.unionByName(one)
    return parts.dropDuplicates(["source_id"])
