"""Link canonicalisation and classes of link outcomes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: scheme, user part, host, port, path, query of an absolute link.
PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#@]*@)?([^/?#:@]+)(?::([0-9]*))?(/[^?#]*)?(\?[^#]*)?(#.*)?$"


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.trim(url), PARTS, group)


def host(url: Column) -> Column:
    return F.nullif(F.lower(part(url, 3)), F.lit(""))


def canonical_https(url: Column) -> Column:
    """HTTPS links without credentials, default port and fragment, with a lower-case host and a path; null for all others."""
    port = part(url, 4)
    where = F.concat(F.lower(part(url, 3)), F.when(port.isin("", "443"), "").otherwise(F.concat(F.lit(":"), port)))
    path = F.when(part(url, 5) == "", "/").otherwise(part(url, 5))
    query = F.when(part(url, 6) == "?", "").otherwise(part(url, 6))
    good = (F.lower(part(url, 1)) == "https") & (part(url, 2) == "") & (part(url, 3) != "")
    return F.when(good, F.concat(F.lit("https://"), where, path, query))


def outcome(status: Column, error: Column) -> Column:
    """Class of a probe: errors before statuses."""
    return (
        F.when(error.startswith("PROTOCOL:"), "PROTOCOL_ERROR").when(error.isNotNull() & (error != ""), "TRANSPORT_ERROR").when(status.isin(401, 403), "DENIED").when(status == 404, "NOT_FOUND")
        .when(status == 429, "RATE_LIMITED").when(status.isNotNull(), F.concat(F.lit("HTTP_STATUS_"), status.cast("string"))).otherwise("TRANSPORT_ERROR")
    )
