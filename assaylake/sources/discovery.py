"""Search payloads of two metadata services as candidate rows; broken envelopes go to a reject table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.text import doi

CROSSREF = (
    "message struct<items: array<struct<DOI: string, title: array<string>, author: array<struct<given: string, family: string>>, `published-print`: struct<`date-parts`: array<array<int>>>, `published-online`: struct<`date-parts`: array<array<int>>>, "
    "issued: struct<`date-parts`: array<array<int>>>, link: array<struct<URL: string, `content-type`: string>>, license: array<struct<URL: string, `content-version`: string, start: struct<`date-parts`: array<array<int>>>>>, URL: string, abstract: string>>>"
)
OPENALEX = (
    "meta struct<count: bigint, cost_usd: double>, results array<struct<id: string, doi: string, title: string, publication_year: int, authorships: array<struct<author: struct<display_name: string>>>, "
    "locations: array<struct<is_oa: boolean, pdf_url: string, landing_page_url: string, license: string, version: string>>>>"
)
CC = r"^https?://(www\.)?creativecommons\.org/(licenses|publicdomain)/"


def split_envelopes(pages: DataFrame, payload: str, schema: str, needed: str) -> tuple[DataFrame, DataFrame]:
    """(parsed, rejected): pages whose payload has the needed part, and the others as they are."""
    parsed = pages.withColumn("_p", F.from_json(payload, schema))
    good = F.coalesce(F.expr(f"_p.{needed} IS NOT NULL"), F.lit(False))
    return parsed.where(good), parsed.where(~good).drop("_p")


def date_of(parts: Column) -> Column:
    """Date of [[year, month, day]], missing month and day as 1; null without a year."""
    first = F.get(parts, 0)
    parts_ = [F.get(first, 0), *(F.coalesce(F.get(first, k), F.lit(1)) for k in (1, 2))]
    return F.when(parts_[0].isNotNull(), F.try_to_timestamp(F.concat_ws("-", *parts_), F.lit("y-M-d")).cast("date"))


def open_license(licenses: Column, today: Column) -> Column:
    """Whether a licence is a CC one of a published version that is in force."""
    return F.exists(licenses, lambda x: x["URL"].rlike(CC) & x["content-version"].isin("vor", "am", "unspecified") & (date_of(x["start"]["date-parts"]) <= today))


def crossref(parsed: DataFrame, today: Column | None = None) -> DataFrame:
    """Candidate rows; a full-text link only with an open licence."""
    now = today if today is not None else F.current_date()
    i = parsed.select(*[c for c in parsed.columns if c != "_p"], F.explode("_p.message.items").alias("i"))
    dates = [F.get(F.col("i")[k]["date-parts"], 0) for k in ("published-print", "published-online", "issued")]
    open_ = F.coalesce(open_license(F.col("i.license"), now), F.lit(False))
    pdf = F.get(F.filter(F.coalesce(F.col("i.link"), F.array()), lambda x: x["content-type"] == "application/pdf"), 0)["URL"]
    return i.select(
        *[c for c in i.columns if c != "i"], doi(F.col("i.DOI")).alias("doi"), F.get("i.title", 0).alias("title"), F.transform("i.author", lambda a: F.concat_ws(" ", a.given, a.family)).alias("authors"), F.coalesce(*[F.get(d, 0) for d in dates]).alias("year"),
        F.col("i.abstract").alias("abstract"), F.col("i.URL").alias("landing_url"), F.when(open_, pdf).alias("fulltext_url"), F.when(open_ & pdf.isNotNull(), "OPEN_FULLTEXT_CANDIDATE").otherwise("UNRESOLVED").alias("access_status"), F.lit("crossref").alias("provider"),
    )


def openalex(parsed: DataFrame) -> DataFrame:
    """Candidate rows; the first open location with a document gives the link."""
    i = parsed.select(*[c for c in parsed.columns if c != "_p"], F.explode("_p.results").alias("i"))
    location = F.get(F.filter(F.coalesce(F.col("i.locations"), F.array()), lambda x: x.is_oa & x.pdf_url.isNotNull()), 0)
    return i.select(
        *[c for c in i.columns if c != "i"], doi(F.col("i.doi")).alias("doi"), F.col("i.id").alias("openalex_id"), F.col("i.title").alias("title"), F.transform("i.authorships", lambda a: a.author.display_name).alias("authors"),
        F.col("i.publication_year").alias("year"), location["landing_page_url"].alias("landing_url"), location["pdf_url"].alias("fulltext_url"), F.when(location.isNotNull(), "OPEN_FULLTEXT_CANDIDATE").otherwise("UNRESOLVED").alias("access_status"), F.lit("openalex").alias("provider"),
    )


def identity(doi_: Column, pii: Column, pdf_sha: Column, title_key: Column, authors: Column, openalex_id: Column) -> Column:
    """The first known of DOI, PII, document hash, title with three authors, service id; null if none: such rows are counted, never merged."""
    known = lambda p, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(p), c))
    names = F.array_join(F.slice(F.array_sort(F.coalesce(authors, F.array().cast("array<string>"))), 1, 3), "|")
    return F.coalesce(known("doi:", doi_), known("pii:", pii), known("pdf:", pdf_sha), F.when(F.coalesce(title_key, F.lit("")) != "", F.concat(F.lit("title:"), title_key, F.lit("|"), names)), known("openalex:", openalex_id))
