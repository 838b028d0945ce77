"""One spelling for each file location."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.sources.tables import ROOT


#: A path without any of these is relative and in its only spelling already, which one pass finds out.
_VARIED = r"^$|^[/.\s]|[\s/]$|\\|//|/\.|^(?i:file):"


def _fold(parts: Column) -> Column:
    """``parts`` with each ``..`` taken together with the part before it."""
    none = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    return F.aggregate(parts, none, step)


def _after(text: Column, start: int) -> Column:
    """All of ``text`` from its character number ``start`` on."""
    return F.substr(text, F.lit(start))


def canonical_path(path: Column, root: str = ROOT) -> Column:
    """The path relative to ``root``, or absolute if it lies elsewhere.

    Outer white space, ``file:`` prefixes, backslashes, doubled slashes, ``.`` and ``..`` are ways
    of writing; letter case and suffix are significant. Null gives null; a blank path gives an
    empty string, the root itself.
    """
    text = F.translate(F.regexp_replace(path, r"^\s+|\s+$", ""), "\\", "/")
    text = F.regexp_replace(text, r"^(?i:file):(?://(?i:localhost)?(?=/))?", "")
    full = F.when(text.startswith("/"), text).otherwise(F.concat(F.lit(root + "/"), text))
    plain = F.regexp_replace(F.regexp_replace(full, r"/(?:\.?/)+", "/"), r"/\.?$", "")
    plain = F.when(plain == "", F.lit("/")).otherwise(plain)
    folded = F.concat(F.lit("/"), F.array_join(_fold(F.split(_after(plain, 2), "/")), "/"))
    whole = F.when(plain.rlike(r"/\.\.(?:/|$)"), folded).otherwise(plain)
    located = F.when(whole == root, F.lit("")).when(whole.startswith(root + "/"), _after(whole, len(root) + 2)).otherwise(whole)
    return F.when(path.rlike(_VARIED), located).otherwise(path)


def location(path: Column, root: str = ROOT) -> Column:
    """``canonical_path`` where ``path`` is known not to be null.

    Its type says so too, so the filters for nulls that joins add are folded away instead of
    computing the path twice. Filter the path itself for nulls before; that filter reaches the scan.
    """
    return F.coalesce(canonical_path(path, root), F.lit(""))
