"""Texts for review: durations, summaries of curing, replaced terms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def shown(value: Column) -> Column:
    """A number without needless digits: six significant ones (the places before the point all stay), no trailing zeros, 0.0 for zero."""
    size = F.floor(F.log10(F.abs(value))).cast("int")
    small = F.regexp_replace(F.regexp_replace(F.format_number(value, 12), ",", ""), r"\.?0+$", "")
    places = F.greatest(F.lit(0), 5 - size)
    rounded = F.round(value * F.pow(F.lit(10.0), places.cast("double"))) / F.pow(F.lit(10.0), places.cast("double"))
    plain = F.regexp_replace(F.regexp_replace(F.format_number(rounded, 10), ",", ""), r"\.?0+$", "")
    return F.when(value == 0, "0.0").when(F.abs(value) < 1e-4, small).otherwise(plain)


def six_digits(value: Column) -> Column:
    """A number of a million or more, rounded to six significant digits; smaller ones are left to `shown`."""
    step = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - 5)
    return F.when(F.abs(value) >= 1e6, F.round(value / step) * step).otherwise(value)


def duration(seconds: Column, unit: Column | None = None) -> Column:
    """Days if the unit says so, hours where they are whole, else seconds to six digits; null for null and for other units."""
    kind = F.coalesce(unit if unit is not None else F.lit(None).cast("string"), F.lit("h"))
    hours = seconds / 3600
    return F.when(kind == "d", F.concat(shown(seconds / 86400), F.lit(" d"))).when(kind == "h", F.when(hours == F.floor(hours), F.concat(shown(hours), F.lit(" h"))).otherwise(F.concat(shown(six_digits(seconds)), F.lit(" s"))))


def curing(method: Column, temperature: Column, humidity: Column, seconds: Column) -> Column:
    """One stage as method, temperature, humidity and duration, what is unknown left out."""
    return F.concat_ws(", ", method, F.concat(shown(temperature), F.lit(" °C")), F.concat(shown(humidity), F.lit(" % RH")), duration(seconds))


def replace_terms(text: Column, terms: dict[str, str]) -> Column:
    """Terms replaced, the longest first, then segments between semicolons once each."""
    out = reduce(lambda c, t: F.replace(c, F.lit(t), F.lit(terms[t])), sorted(terms, key=lambda t: (-len(t), t)), text)
    return F.array_join(F.array_distinct(F.transform(F.split(out, ";"), lambda s: F.trim(s))), "; ")
