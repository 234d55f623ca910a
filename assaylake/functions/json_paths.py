"""JSON pointers, canonical texts and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def escape_token(token: Column) -> Column:
    return F.replace(F.replace(token, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def unescape_token(token: Column) -> Column:
    return F.replace(F.replace(token, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~"))


def pointer(*tokens: Column) -> Column:
    return F.concat(*[x for t in tokens for x in (F.lit("/"), escape_token(t))])


def read(text: Column, path: str, kind: str = "string") -> Column:
    """Value at a pointer of a JSON text; null where the text is broken or has no such value."""
    tokens = [t.replace("~1", "/").replace("~0", "~") for t in path.split("/")[1:]]
    where = "$" + "".join(f"[{t}]" if t.isdigit() else f"['{t}']" for t in tokens)
    return F.try_variant_get(F.try_parse_json(text), where, kind)


def canonical(**fields: Column) -> Column:
    """JSON text with sorted names and nulls kept."""
    return F.to_json(F.struct(*[fields[n].alias(n) for n in sorted(fields)]), {"ignoreNullFields": "false"})


def content_id(size: int = 64, **fields: Column) -> Column:
    """Hash of the canonical text, cut to `size` digits."""
    return F.substr(F.sha2(canonical(**fields).cast("binary"), 256), F.lit(1), F.lit(size))


def value_kind(value: Column) -> Column:
    """JSON kind of a text: null, boolean, number, string, array, object; null for broken texts."""
    kind = F.schema_of_variant(F.try_parse_json(value))
    return (
        F.when(kind == "VOID", "null").when(kind == "BOOLEAN", "boolean").when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object").when(kind == "STRING", "string").when(kind.isNotNull(), "number")
    )
