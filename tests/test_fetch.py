"""Fetching by a given transport, and where each request is answered from."""

import pytest
from pyspark.sql import functions as F

from assaylake.sources import fetch

HOSTS = ("api.example.org",)


def answers(*given):
    left, waits = list(given), []

    def transport(url, timeout):
        got = left.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    return transport, waits


def test_attempts_and_waits():
    transport, waits = answers((503, {"Retry-After": "90"}, b""), (429, {}, b""), (200, {}, b'{"a": 1}'))
    got = fetch.fetch_one("https://api.example.org/x", transport, HOSTS, sleep=waits.append)
    assert (got["status"], got["attempts"], got["payload"]) == ("OK", 3, '{"a": 1}') and waits == [0.0, 30.0, 5.0]
    transport, waits = answers(OSError(), TimeoutError(), OSError())
    assert fetch.fetch_one("https://api.example.org/x", transport, HOSTS, sleep=waits.append) == {"status": "TRANSPORT_FAILURE", "attempts": 3, "error": "OSError"} and waits == [0.0, 2.0, 5.0]
    for answer, error in (((404, {}, b""), "HTTP_404"), ((200, {}, b"<p>"), "NOT_JSON"), ((200, {}, b"[" + b" " * 60 + b"]"), "TOO_LARGE")):
        got = fetch.fetch_one("https://api.example.org/x", answers(answer)[0], HOSTS, most_bytes=50, sleep=lambda s: None)
        assert (got["status"], got["error"], got["attempts"]) == ("TERMINAL_FAILURE", error, 1)
    for url, error in (("http://api.example.org/x", "NOT_HTTPS"), ("https://other.org/", "HOST_NOT_ALLOWED"), ("https://u:p@api.example.org/", "NOT_PLAIN_HOST"), ("https://api.example.org:8443/", "NOT_PLAIN_HOST")):
        assert fetch.fetch_one(url, answers()[0], HOSTS, sleep=lambda s: None)["error"] == error


def test_receipts_of_all_requests(spark):
    def transport(url, timeout):
        return (200, {}, b"{}") if url.endswith("1") else (404, {}, b"")

    rows = spark.createDataFrame([(f"https://api.example.org/{i % 3}", "v1") for i in range(6)], "url string, contract string")
    got = fetch.fetch_pages(rows, transport, HOSTS, sleep=lambda s: None).collect()
    assert sorted((r["status"], r["payload"]) for r in got if r["payload"]) == [("OK", "{}")] and len(got) == 3


def test_filters():
    assert fetch.SearchFilter(2018, 2020, True, True).remote() == "from_publication_date:2018-01-01,to_publication_date:2020-12-31,is_oa:true,has_fulltext:true" and fetch.SearchFilter().remote() is None
    for wrong in ((999, None), (None, 10000), (2020, 2018)):
        with pytest.raises(ValueError):
            fetch.SearchFilter(*wrong)


def test_local_filters(spark):
    rows = spark.createDataFrame([(2018.0, True, True), (2017.5, True, True), (None, True, True), (2019.0, None, True), (2019.0, True, False)], "y double, o boolean, f boolean")
    keep = fetch.SearchFilter(2017, 2019, True, True).local(F.col("y"), F.col("o"), F.col("f"))
    assert [r[0] for r in rows.select(keep).collect()] == [True, False, False, False, False]


def test_pacing(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "host string, n int")
    assert [r["starts_at"] for r in fetch.spread_over(rows, "host", "n", 1.05).orderBy("n").collect()] == pytest.approx([0, 1.05, 0])
