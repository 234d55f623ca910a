"""Pages of allow-listed JSON interfaces: which request is answered from where, and the fetch itself with retries and budgets.

The transport is a function that the caller gives, (url, timeout) to (status, headers, body); tests and replays give one
that reads nothing from a network. Every request ends in one receipt row, failures included.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Waits before the attempts and the longest wait that a server may ask for, in seconds; days that a page stays fresh.
WAITS, LONGEST_WAIT, FRESH_DAYS = (0.0, 2.0, 5.0), 30.0, 30
RETRIED = (429, 500, 502, 503, 504)
RECEIPT = "url_sha256 string, contract string, status string, http_status int, attempts int, error string, payload string, payload_sha256 string, bytes long"

Transport = Callable[[str, float], tuple[int, dict[str, str], bytes]]


@dataclass(frozen=True)
class SearchFilter:
    """What a search may ask for; wrong bounds are an error when it is made."""

    year_from: int | None = None
    year_to: int | None = None
    oa_only: bool = False
    has_fulltext: bool = False

    def __post_init__(self):
        for name in ("year_from", "year_to"):
            year = getattr(self, name)
            if year is not None and not 1000 <= year <= 9999:
                raise ValueError(f"{name} must be a four-digit year")
        if self.year_from is not None and self.year_to is not None and self.year_from > self.year_to:
            raise ValueError("year_from must not exceed year_to")

    def remote(self) -> str | None:
        """The interface's own filter, so that it sends no more than is asked for."""
        parts = [f"from_publication_date:{self.year_from:04d}-01-01" if self.year_from else "", f"to_publication_date:{self.year_to:04d}-12-31" if self.year_to else "", "is_oa:true" * self.oa_only, "has_fulltext:true" * self.has_fulltext]
        return ",".join(p for p in parts if p) or None

    def local(self, year: Column, is_open: Column, fulltext: Column) -> Column:
        """The same as a condition on rows; a year that is no whole number fails a bound."""
        whole = F.when(year == F.floor(year), year)
        found = [F.lit(True)]
        found += [whole >= self.year_from] if self.year_from is not None else []
        found += [whole <= self.year_to] if self.year_to is not None else []
        found += [is_open] if self.oa_only else []
        found += [fulltext] if self.has_fulltext else []
        out = found[0]
        for more in found[1:]:
            out = out & F.coalesce(more, F.lit(False))
        return out


def refused(url: str, hosts: tuple[str, ...]) -> str | None:
    """Why a URL may not be fetched; None if it may."""
    parts = urlsplit(url)
    if parts.scheme != "https":
        return "NOT_HTTPS"
    if parts.username or parts.password or parts.port not in (None, 443):
        return "NOT_PLAIN_HOST"
    return None if (parts.hostname or "").lower() in hosts else "HOST_NOT_ALLOWED"


def json_fault(body: bytes) -> str | None:
    try:
        json.loads(body)
    except ValueError:
        return "NOT_JSON"
    return None


def pdf_fault(body: bytes) -> str | None:
    return None if body.startswith(b"%PDF-") else "NOT_A_PDF"


def fetch_one(url: str, transport: Transport, hosts: tuple[str, ...], timeout: float = 30.0, most_bytes: int = 50 << 20, sleep: Callable[[float], None] = time.sleep, fault: Callable[[bytes], str | None] = json_fault) -> dict:
    """Status, attempts and body of one request: up to three attempts, waiting as WAITS or the server says; `fault` names what is wrong with a body."""
    if why := refused(url, hosts):
        return {"status": "TERMINAL_FAILURE", "attempts": 0, "error": why}
    out: dict = {}
    asked = 0.0
    for number, wait in enumerate(WAITS, 1):
        sleep(max(wait, asked))
        asked = 0.0
        try:
            code, headers, body = transport(url, timeout)
        except OSError as e:
            out = {"status": "TRANSPORT_FAILURE", "attempts": number, "error": type(e).__name__}
            continue
        out = {"http_status": code, "attempts": number, "bytes": len(body)}
        if code == 200:
            if len(body) > most_bytes:
                return out | {"status": "TERMINAL_FAILURE", "error": "TOO_LARGE"}
            if wrong := fault(body):
                return out | {"status": "TERMINAL_FAILURE", "error": wrong}
            return out | {"status": "OK", "payload": body.decode("utf-8") if fault is json_fault else body, "payload_sha256": hashlib.sha256(body).hexdigest()}
        out |= {"status": "TRANSPORT_FAILURE" if code in RETRIED else "TERMINAL_FAILURE", "error": f"HTTP_{code}"}
        if code not in RETRIED:
            return out
        said = headers.get("Retry-After", "")
        asked = min(float(said), LONGEST_WAIT) if said.isdecimal() else 0.0
    return out


def fetch_pages(requests: DataFrame, transport: Transport, hosts: tuple[str, ...], at_once: int = 2, **options) -> DataFrame:
    """Receipts of requests (url, contract), each URL once; `at_once` tasks ask at a time."""
    names = [c.split()[0] for c in RECEIPT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [{"url_sha256": hashlib.sha256(r.url.encode()).hexdigest(), "contract": r.contract} | fetch_one(r.url, transport, hosts, **options) for r in batch.itertuples()]
            yield pd.DataFrame(rows, columns=names).astype(object).where(lambda x: x.notna(), None)

    return requests.select("url", "contract").distinct().repartition(at_once).mapInPandas(run, RECEIPT)


def fetch_documents(requests: DataFrame, transport: Transport, hosts: tuple[str, ...], at_once: int = 2, most_bytes: int = 100 << 20, **options) -> DataFrame:
    """(url, status, error, attempts, bytes, sha256, content) of PDF documents, each URL once: allowed hosts only, up to three attempts, a size cap, and the mark of a PDF; a document's name is its hash."""
    names = ("url", "status", "error", "attempts", "bytes", "sha256", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for url in batch["url"]:  # one document at a time: they are large
                got = fetch_one(url, transport, hosts, most_bytes=most_bytes, fault=pdf_fault, **options)
                row = (url, got.get("status"), got.get("error"), got.get("attempts"), got.get("bytes"), got.get("payload_sha256"), got.get("payload"))
                yield pd.DataFrame([row], columns=names).astype(object).where(lambda x: x.notna(), None)

    return requests.select("url").distinct().repartition(at_once).mapInPandas(run, "url string, status string, error string, attempts int, bytes long, sha256 string, content binary")


def request_plan(requests: DataFrame, receipts: DataFrame, seeds: DataFrame, now: Column, max_requests: int, max_bytes: int, bytes_each: int) -> DataFrame:
    """`requests` (place, url_sha256, contract) with source: CACHE, REPLAYED_FAILURE, SEED, NETWORK or OVER_BUDGET.

    receipts: url_sha256, contract, status, fetched_at; seeds: url_sha256, contract, of an earlier run. A fresh page goes before a failure that is
    replayed, both before a seed, and only the rest may use the network, in their order, until the requests or bytes are used up.
    """
    keys = ["url_sha256", "contract"]
    age = now - F.expr(f"INTERVAL {FRESH_DAYS} DAYS")
    seen = receipts.groupBy(*keys).agg(F.bool_or((F.col("status") == "OK") & (F.col("fetched_at") >= age)).alias("_fresh"), F.bool_or(F.col("status") == "TERMINAL_FAILURE").alias("_failed"))
    met = requests.join(seen, keys, "left").join(seeds.select(*keys).distinct().withColumn("_seed", F.lit(True)), keys, "left")
    first = F.when(F.coalesce("_fresh", F.lit(False)), "CACHE").when(F.coalesce("_failed", F.lit(False)), "REPLAYED_FAILURE").when(F.col("_seed"), "SEED").otherwise("NETWORK")
    marked = met.withColumn("source", first)
    able = min(max_requests, max_bytes // bytes_each)
    sent = marked.where("source = 'NETWORK'").orderBy("place").limit(able).select("place", F.lit(True).alias("_sent"))
    return marked.join(sent, "place", "left").select(*requests.columns, F.when((F.col("source") == "NETWORK") & F.col("_sent").isNull(), "OVER_BUDGET").otherwise(F.col("source")).alias("source"))


def spread_over(rows: DataFrame, host: str, order: str, seconds: float) -> DataFrame:
    """`rows` with starts_at: seconds after the beginning at which each may be sent, so that a host is asked once in `seconds`."""
    return rows.withColumn("starts_at", (F.row_number().over(Window.partitionBy(host).orderBy(order)) - 1) * F.lit(seconds))
