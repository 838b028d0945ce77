"""Content-derived identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_json(text: Column) -> Column:
    """JSON text with every character beyond ASCII written as ``\\uXXXX`` (pairs for those beyond U+FFFF)."""
    escaped = F.transform(
        F.split(text, ""),
        lambda c: F.when(c.rlike(r"[^\x00-\x7f]"), F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")).otherwise(c),
    )
    return F.when(text.rlike(r"[^\x00-\x7f]"), F.array_join(escaped, "")).otherwise(text)


def sorted_pairs(params: Column) -> Column:
    """A map as an array of ``[key, value]`` arrays in the order of the keys; null as an empty one."""
    entries = F.array_sort(F.map_entries(F.coalesce(params, F.create_map().cast("map<string,string>"))))
    return F.transform(entries, lambda e: F.array(e["key"], e["value"]))


def content_id(prefix: str, length: int = 24, ascii_only: bool = True, **fields: Column) -> Column:
    """``prefix`` and the first hex digits of the SHA-256 of the fields as canonical JSON with sorted keys."""
    whole = F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})
    return F.concat(F.lit(prefix), F.substring(F.sha2(ascii_json(whole) if ascii_only else whole, 256), 1, length))


def framed(text: Column) -> Column:
    """The UTF-8 bytes of a text after their number as eight big-endian bytes."""
    data = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    return F.concat(F.unhex(F.lpad(F.hex(F.octet_length(data)), 16, "0")), data)


def row_digest(pairs: Column) -> Column:
    """The SHA-256 of a row given as an array of (name, value): order counts, and absent differs from empty."""
    empty = F.lit(b"").cast("binary")
    return F.sha2(F.aggregate(pairs, empty, lambda done, p: F.concat(done, framed(p["name"]), framed(p["value"]))), 256)
