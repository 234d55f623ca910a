"""Identifiers, printed numbers and closed vocabularies as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The grammar of a DOI and of a printed number.
DOI = r"10\.[0-9]{4,9}/[-._;()/:a-z0-9]+"
NUMBER = r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"


def fold(text: Column) -> Column:
    """Lower case in which ß counts as ss, as full case folding has it."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def doi(text: Column) -> Column:
    """The first DOI of a text in lower case, without closing punctuation; null if there is none."""
    found = F.rtrim(F.regexp_extract(F.lower(text), DOI, 0), F.lit(".,;)"))
    return F.nullif(found, F.lit(""))


def title_key(text: Column) -> Column:
    """Folded title with every run of other characters than letters a-z and digits as one space."""
    return F.trim(F.regexp_replace(fold(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def printed_number(text: Column) -> Column:
    """A cell's number: footnote marks and brackets at the ends go, thousands commas too; null for dashes and text."""
    plain = F.btrim(F.replace(F.trim(text), F.lit("−"), F.lit("-")), F.lit(" ,;()%*†‡"))
    grouped = plain.rlike(r"^[+-]?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]+)?$")
    return F.when(plain.rlike(f"^{NUMBER}$") | grouped, F.replace(plain, F.lit(","), F.lit("")).cast("double"))


def quantity(text: Column) -> Column:
    """struct(value, relation, lower, upper, bound, tolerance): a printed quantity and its qualifier."""
    own = F.replace(F.trim(text), F.lit("−"), F.lit("-"))
    about = rf"^(?i:~|≈|∼|about\s+|around\s+|approximately\s+|约\s*)({NUMBER})$"
    span = rf"^({NUMBER})\s*(?i:–|—|-|to)\s*({NUMBER})$"
    limit = rf"^(<=|>=|≤|≥|<|>)\s*({NUMBER})$"
    plus_minus = rf"^({NUMBER})\s*±\s*({NUMBER})$"

    def part(pattern: str, group: int) -> Column:
        return F.when(own.rlike(pattern), F.regexp_extract(own, pattern, group).cast("double"))

    plain = rf"^({NUMBER})$"
    relation = (
        F.when(own.rlike(plain), "exact").when(own.rlike(about), "approximate").when(own.rlike(span), "range").when(own.rlike(limit), F.regexp_extract(own, limit, 1))
        .when(own.rlike(plus_minus), "plus_minus").when(F.lower(own) == "max", "above_instrument_range").when(own.isNotNull(), "textual_quantity")
    )
    return F.struct(
        F.coalesce(part(plain, 1), part(about, 1), part(plus_minus, 1)).alias("value"),
        relation.alias("relation"),
        part(span, 1).alias("lower"),
        part(span, 2).alias("upper"),
        part(limit, 2).alias("bound"),
        part(plus_minus, 2).alias("tolerance"),
    )


def multiple_values(text: Column) -> Column:
    """Whether a fact lists several quantities where one is allowed."""
    return (F.size(F.regexp_extract_all(text, F.lit(f"({NUMBER})"), F.lit(1))) > 1) & text.rlike(r";|\band\b|\brespectively\b")


#: Words that name a kind of specimen, and the tokens of foaming agents.
SPECIMENS = {"paste": r"\bpaste\b|净浆|浆体", "mortar": r"\bmortar\b|砂浆", "concrete": r"\bconcrete\b|混凝土"}
FOAMING_AGENTS = ("h2o2", "spc")


def only_class(text: Column, patterns: dict[str, str], otherwise: str | None = None) -> Column:
    """The name of the one pattern that matches; `otherwise` for none or several."""
    hits = [text.rlike(p) for p in patterns.values()]
    count = sum((h.cast("int") for h in hits), F.lit(0))
    named = F.coalesce(*[F.when(h, F.lit(n)) for n, h in zip(patterns, hits, strict=True)])
    return F.coalesce(F.when(count == 1, named), F.lit(otherwise))


def specimen_type(text: Column) -> Column:
    return only_class(F.lower(F.coalesce(text, F.lit(""))), SPECIMENS)


def foaming_agent(identity: Column) -> Column:
    plain = F.translate(fold(F.coalesce(identity, F.lit(""))), "₀₁₂₃₄₅₆₇₈₉", "0123456789")
    return only_class(plain, {n: rf"(?<![\w]){n}(?![\w])" for n in FOAMING_AGENTS}, "foaming_agent")


#: Units that a header may print in brackets, the shares that brackets may name, and durations that a token may print.
HEADER_UNITS = ("kg/m3", "g/cm3", "g/L", "kg/L", "mol/L", "M", "g", "kg", "mg", "mL", "L")
SHARES = {"vol": "volume", "vol.": "volume", "volume": "volume", "wt": "mass", "wt.": "mass", "weight": "mass", "mass": "mass"}
DURATIONS = ("s", "min", "h", "d", "hours", "days")


def _ascii_forms() -> dict[str, str]:
    """Characters whose compatibility form (NFKC) is ASCII, from the Unicode tables."""
    forms = ((chr(c), unicodedata.normalize("NFKC", chr(c))) for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000)
    return {c: form for c, form in forms if form.isascii()}


def plain_form(text: Column) -> Column:
    """A text with every character that stands for ASCII ones written in these: brackets and digits of full width, superscripts, squared units."""
    forms = _ascii_forms()
    single = {c: f for c, f in forms.items() if len(f) == 1}
    out = F.translate(text, "".join(single), "".join(single.values()))
    for c, form in forms.items():
        if len(form) > 1 and (form in HEADER_UNITS or form in SHARES or "/" in form or form in ("m2", "m3", "cm2", "cm3", "mm2", "mm3")):
            out = F.replace(out, F.lit(c), F.lit(form))
    return out


def header_unit(header: Column, fallback: Column) -> Column:
    """Unit that a table header prints.

    What the brackets hold is read first: one printed unit decides. Otherwise the header prints a percentage
    (of volume, of mass or of neither) or a ratio (of what its brackets or words name), or else the fallback holds.
    """
    plain = plain_form(header)
    low = F.lower(plain)
    held = F.regexp_extract_all(F.regexp_replace(plain, r"\s+", ""), F.lit(r"[(\[]([^()\[\]]*)[)\]]"), F.lit(1))
    units = F.array_intersect(held, F.array(*map(F.lit, HEADER_UNITS)))
    share_of = F.create_map(*[F.lit(x) for kv in SHARES.items() for x in kv])
    named = F.transform(F.regexp_extract_all(low, F.lit(r"\(([^()]*)\)"), F.lit(1)), lambda x: share_of[x])
    percentage = F.when(F.contains(low, F.lit("vol")), "vol.%").when(low.rlike(r"(wt\.?|weight|mass)\s*%"), "wt.%").otherwise("%")
    word = F.regexp_extract(low, r"(mass|molar)\s+ratio", 1)
    of = F.when(F.array_contains(named, "volume"), "volume ").when(F.array_contains(named, "mass") | low.rlike(r"mass\s+ratio"), "mass ").when(word != "", F.concat(word, F.lit(" "))).when(low.rlike(r"\bratio\b"), "")
    return F.when(F.size(units) == 1, units[0]).when(F.contains(plain, F.lit("%")), percentage).otherwise(F.coalesce(F.concat(of, F.lit("ratio")), fallback))


def time_unit(value: Column, unit: Column, token: Column) -> Column:
    """The unit that a token such as "24 h" prints beside this very value; otherwise the given one."""
    printed = rf"^\s*([+-]?[0-9]+(?:\.[0-9]+)?)\s*({'|'.join(DURATIONS)})\s*$"
    same = F.regexp_extract(token, printed, 1).try_cast("double") == value
    return F.when(F.coalesce(token.rlike(printed) & same, F.lit(False)), F.regexp_extract(token, printed, 2)).otherwise(unit)


def specimen_key(identity: Column) -> Column:
    """A specimen's identity as printed, without white space around it; null for none."""
    return F.nullif(F.regexp_replace(identity, r"^\s+|\s+$", ""), F.lit(""))


def coded_composition(identity: Column) -> Column:
    """map of letter to share for identities such as C70G30U0; null unless the shares add up to 100."""
    whole = identity.rlike(r"^([A-Z][0-9]+){2,}$")
    shares = F.regexp_extract_all(identity, F.lit("([0-9]+)"), F.lit(1)).cast("array<double>")
    letters = F.regexp_extract_all(identity, F.lit("([A-Z])"), F.lit(1))
    good = whole & (F.aggregate(shares, F.lit(0.0), lambda a, x: a + x) == 100) & (F.size(F.array_distinct(letters)) == F.size(letters))
    return F.when(good, F.map_from_arrays(letters, shares))


def truncated_snippet(text: Column, size: int = 240) -> Column:
    """struct(snippet, sha256): the beginning of a text with the hash of the whole one."""
    return F.struct(F.substr(text, F.lit(1), F.lit(size)).alias("snippet"), F.sha2(text.cast("binary"), 256).alias("sha256"))


def sentences(text: Column) -> Column:
    """Distinct sentences in order of first appearance."""
    return F.array_distinct(F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+"), lambda s: F.trim(s)), lambda s: s != ""))


def section_heading(text: Column, known: tuple[str, ...] = ("abstract", "introduction", "methods", "results", "conclusions", "references")) -> Column:
    """The first line where it is a heading: at most 80 characters, numbered or one of the known titles."""
    first = F.trim(F.split(F.coalesce(text, F.lit("")), "\n")[0])
    numbered = first.rlike(r"^[0-9]+\.(?:[0-9]+\.?)*\s+[A-Za-z]")
    return F.when((F.length(first) <= 80) & (numbered | F.lower(first).isin(*known)), first)


def utc_time(text: Column) -> Column:
    """Time of an RFC 3339 text; null where it has no zone."""
    return F.when(text.rlike(r"(?i)(Z|[+-][0-9]{2}:?[0-9]{2})$"), F.try_to_timestamp(text))


def oxide_label(header: Column) -> Column:
    """A component header without spaces and subscripts; marked losses on ignition become LOI."""
    plain = F.translate(F.regexp_replace(header, r"\s+", ""), "₀₁₂₃₄₅₆₇₈₉", "0123456789")
    return F.when(plain.rlike(r"^LOI[a-z*†‡]$"), "LOI").otherwise(plain)


def is_component(header: Column) -> Column:
    """Whether a header names an oxide, a sum of oxides, LOI or the rest."""
    oxide = r"[A-Z][a-z]?[0-9]*O[0-9]*"
    return oxide_label(header).rlike(rf"^({oxide}(\+{oxide})*|LOI|Others?)$")


#: "A, B and C had d50 of 12, 15 and 18 um, respectively": names, values in the same order, one unit.
NAME, JOINED, UNIT = r"[A-Za-z][\w-]*", r"(?:, and |, | and )", r"[A-Za-zµμ%/0-9]+"
RESPECTIVE = rf"\b({NAME}(?:{JOINED}{NAME})+) (?:was|were|is|are|has|have|had|showed|with)\b[^.;]*?({NUMBER}(?: ?{UNIT})?(?:{JOINED}{NUMBER}(?: ?{UNIT})?)*{JOINED}{NUMBER}) ?({UNIT}),? respectively"


def respective_pairs(text: Column) -> Column:
    """array<struct(name, value, unit)> of the first sentence that pairs names with as many values; empty for repeated names, lists of unequal length and other sentences."""

    def parts(t: Column) -> Column:
        names, values = F.split(F.regexp_extract(t, RESPECTIVE, 1), JOINED), F.regexp_extract_all(F.regexp_extract(t, RESPECTIVE, 2), F.lit(rf"(?:^|(?<=[, ]))({NUMBER})"), F.lit(1))
        return F.struct(t.rlike(RESPECTIVE).alias("said"), names.alias("names"), values.alias("values"), F.regexp_extract(t, RESPECTIVE, 3).alias("unit"))

    def paired(p: Column) -> Column:
        good = p["said"] & (F.size(p["names"]) == F.size(p["values"])) & (F.size(F.array_distinct(p["names"])) == F.size(p["names"]))
        pairs = F.zip_with(p["names"], p["values"], lambda n, v: F.struct(n.alias("name"), v.cast("double").alias("value"), p["unit"].alias("unit")))
        return F.when(good, pairs).otherwise(F.array().cast("array<struct<name: string, value: double, unit: string>>"))

    # lists of one: a lambda's variable is computed once, however often it is named
    return F.get(F.transform(F.transform(F.array(text), parts), paired), F.lit(0))


def phase_shares(text: Column, tolerance: float = 0.11) -> Column:
    """struct(shares, total, complete): phases with their percentages and whether these add up to 100; a repeated phase makes the map null."""
    pattern = r"([A-Z][a-z]+(?: phase)?)\s*[(:=]?\s*([0-9]+(?:\.[0-9]+)?)\s*(?:wt\.?\s*)?%"
    names, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).cast("array<double>")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    distinct = F.size(F.array_distinct(names)) == F.size(names)
    return F.struct(F.when(distinct, F.map_from_arrays(names, values)).alias("shares"), total.alias("total"), (distinct & (F.abs(total - 100) <= tolerance)).alias("complete"))
