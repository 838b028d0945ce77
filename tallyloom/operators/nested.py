"""Deeply nested records as related flat tables.

A payload, XML or JSON, is streamed into path-value-ordinal triples: the table of the nearest repeated
ancestor, the ordinals of the repeated ancestors, the path of a leaf below the nearest one, its text.
Triples with the same ancestors are pivoted into one row; rows at the same path form one table, and
the ordinals link it to its parents. A record is handled in one task without a shuffle.

Some levels are declared (``NEST``), because they come in several spellings. All other repeated
ancestors are found in the data: ``discover`` reads all records once and tells which paths are
repeated and hold elements of their own. That is the ``Layout``: a table for each of them, a column
for each field, bounded by the number of different paths and not by that of the records.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from json.decoder import scanstring
from typing import Any
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame

#: A level of repeated elements: the element that wraps the list, and the element of each entry.
NEST = (("items", "item"), ("majorList", "major"), ("quotaList", "quota"))
TABLES = ("items", "majors", "quotas")

#: Characters of a document that the parser is given at a time.
PIECE = 1 << 16
#: The field that holds an entry's own text, where an entry is a plain value.
OWN = "#text"

#: Table (the whole path of its entries below an item), ordinals, path below the entry, value.
Triple = tuple[str, tuple[int, ...], str, "str | None"]


class Seen:
    """What a pass over records meets: paths that are repeated, paths that hold elements, and the leaves of the declared levels."""

    def __init__(self) -> None:
        self.found: set[tuple[str, str, str]] = set()

    def note(self, what: str, table: str, path: str) -> None:
        self.found.add((what, table, path))


def joined(*parts: str) -> str:
    return "/".join(filter(None, parts))


@lru_cache(100_000)
def local_name(name: str) -> str:
    """``name`` without namespace, prefix and outer white space."""
    return name.strip().rpartition("}")[2].rpartition(":")[2].strip()


def _xml_triples(text: str, nest: tuple[tuple[str, str], ...], extra: frozenset[str], seen: Seen | None) -> list[Triple]:
    out: list[Triple] = []
    names: list[str] = []
    rows: list[tuple[int, str, tuple[int, ...], int]] = []  # open entries: depth, table, ordinals, declared levels above and here
    counts: list[dict[str, int]] = [{}]  # by open entry: how many entries of each table it has
    twins: list[dict[str, int]] = [{}]  # by open element: how many children of each name it has
    inner = [False]
    words: list[str] = []

    def opened(name: str) -> tuple[str, int] | None:
        """The table and the declared level of an element that is an entry."""
        if not rows:
            return ("", 1) if name == nest[0][1] else None
        depth, table, _, level = rows[-1]
        between = names[depth:]
        if 0 < level < len(nest) and name == nest[level][1] and between in ([], [nest[level][0]]):
            return joined(table, *nest[level]), level + 1
        if extra and (whole := joined(table, *between, name)) in extra:
            return whole, 0
        return None

    entry_names = {entry for _, entry in nest}

    def start(name: str, _: Any) -> None:
        name = local_name(name) if ":" in name or "}" in name else name
        entry = opened(name) if extra or name in entry_names else None
        if seen is not None and rows:
            if not (entry and entry[1]):
                twins[-1][name] = twins[-1].get(name, 0) + 1
                if twins[-1][name] == 2:
                    seen.note("repeated", "", joined(rows[-1][1], *names[rows[-1][0] :], name))
            twins.append({})
        elif seen is not None:
            twins.append({})
        if entry:
            counts[-1][entry[0]] = number = counts[-1].get(entry[0], 0) + 1
            at = (*rows[-1][2], number) if rows else (number,)
            rows.append((len(names) + 1, entry[0], at, entry[1]))
            counts.append({})
            out.append((entry[0], at, "", None))
        names.append(name)
        inner[-1] = True
        inner.append(False)
        words.clear()

    def end(_: str) -> None:
        if rows:
            depth, table, at, level = rows[-1]
            size = len(names)
            if size == depth:
                own = "" if inner[-1] else "".join(words).strip()
                if own:
                    out.append((table, at, OWN, own))
                    if seen is not None:
                        seen.note("leaf", table, OWN)
                rows.pop()
                counts.pop()
            elif inner[-1]:
                if seen is not None:
                    seen.note("object", "", joined(table, *names[depth:]))
            else:
                path = names[-1] if size == depth + 1 else "/".join(names[depth:])
                value = words[0].strip() if len(words) == 1 else "".join(words).strip()
                if value or not (0 < level < len(nest) and path == nest[level][0]):  # an empty wrapper is no value
                    out.append((table, at, path, value))
                    if seen is not None:
                        seen.note("leaf", table, path)
        names.pop()
        inner.pop()
        if seen is not None:
            twins.pop()
        words.clear()

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, words.append
    for begin in range(0, max(1, len(text)), PIECE):
        parser.Parse(text[begin : begin + PIECE], begin + PIECE >= len(text))
    return out


def elements(text: str) -> Iterator[tuple[tuple[str, ...], tuple[int, ...], str]]:
    """Every element of an XML document in the order of the document, as a path-ordinal-value triple.

    The path has the local names from the root down, the ordinals the place of each among its
    siblings, and the value is the stripped text before the first child. A document that is not
    well-formed ends with an ``ExpatError``.
    """
    ready: list[tuple[tuple[str, ...], tuple[int, ...], str]] = []
    path: tuple[str, ...] = ()
    at: tuple[int, ...] = ()
    born = [0]  # children so far, by depth
    words: list[str] = []
    waiting = False  # the innermost element has neither child nor end yet

    def settle() -> None:
        nonlocal waiting
        if waiting:
            ready.append((path, at, "".join(words).strip()))
        waiting = False
        words.clear()

    def start(name: str, _: Any) -> None:
        nonlocal path, at, waiting
        settle()
        born[-1] += 1
        path, at = (*path, local_name(name)), (*at, born[-1])
        born.append(0)
        waiting = True

    def end(_: str) -> None:
        nonlocal path, at
        settle()
        path, at = path[:-1], at[:-1]
        born.pop()

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, words.append
    for begin in range(0, max(1, len(text)), PIECE):
        parser.Parse(text[begin : begin + PIECE], begin + PIECE >= len(text))
        yield from ready
        ready.clear()


_BLANK = re.compile(r"[ \t\n\r]*")
_BLANKS, _DIGITS = frozenset(" \t\n\r"), frozenset("-0123456789")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
_WORD = re.compile(r"true|false|null")


def _stream(text: str, at: int, sink: Any) -> int:
    """Tells ``sink`` of the JSON value at ``at`` as it is read, and returns where it ends; an error for what is not JSON.

    A sink is told of a ``scalar`` (its text, None for null, and whether it is a string) or asked for the
    sinks of the ``key`` values of an ``object`` or of the ``item`` values of a ``list``, which are closed
    at their end.
    """
    at = _BLANK.match(text, at).end()
    first = text[at : at + 1]
    if first == '"':
        value, end = scanstring(text, at + 1, True)
        sink.scalar(value, True)
        return end
    if first == "{" or first == "[":
        inner, close = (sink.object(), "}") if first == "{" else (sink.list(), "]")
        at = _BLANK.match(text, at + 1).end()
        if text[at : at + 1] != close:
            while True:
                if close == "]":
                    at = _stream(text, at, inner.item())
                else:
                    if text[at : at + 1] != '"':
                        raise ValueError(f"no name at {at}")
                    name, at = scanstring(text, at + 1, True)
                    at = _BLANK.match(text, at).end()
                    if text[at : at + 1] != ":":
                        raise ValueError(f"no value at {at}")
                    at = _BLANK.match(text, at + 1).end()
                    first = text[at : at + 1]
                    if first == '"':  # most values are texts and numbers, so they need no sink of their own
                        value, at = scanstring(text, at + 1, True)
                        inner.leaf(local_name(name), value, True)
                    elif first in _DIGITS and (found := _NUMBER.match(text, at)):
                        at = found.end()
                        inner.leaf(local_name(name), found.group(), False)
                    else:
                        at = _stream(text, at, inner.key(local_name(name)))
                after = text[at : at + 1]
                if after in _BLANKS:
                    at = _BLANK.match(text, at).end()
                    after = text[at : at + 1]
                if after == close:
                    break
                if after != ",":
                    raise ValueError(f"no end at {at}")
                at = _BLANK.match(text, at + 1).end()
        inner.close()
        return at + 1
    if found := _NUMBER.match(text, at):
        sink.scalar(found.group(), False)
    elif found := _WORD.match(text, at):
        sink.scalar(None if first == "n" else found.group(), False)
    else:
        raise ValueError(f"no value at {at}")
    return found.end()


def _stream_all(text: str, sink: Any) -> None:
    if _BLANK.match(text, _stream(text, 0, sink)).end() != len(text):
        raise ValueError("more than one value")


class _Skip:
    """Takes what is of no interest."""

    def object(self) -> _Skip:
        return self

    def list(self) -> _Skip:
        return self

    def key(self, name: str) -> _Skip:
        return self

    def item(self) -> _Skip:
        return self

    def scalar(self, value: str | None, string: bool) -> None:
        pass

    def leaf(self, name: str, value: str, string: bool) -> None:
        """A text or a number as the value of a name."""
        self.key(name).scalar(value, string)

    def close(self) -> None:
        pass


_SKIP = _Skip()


@dataclass(slots=True)
class _Read:
    """What holds for a whole payload: the levels, and the rank of the list that was taken, by the depth of its name."""

    nest: tuple[tuple[str, str], ...]
    extra: frozenset[str]
    seen: Seen | None
    out: list[Triple]
    rank: float = math.inf


class _Leaf(_Skip):
    """A value inside an entry at ``path``: a leaf, an object of leaves, or a row of a table of its own."""

    def __init__(self, read: _Read, out: list[Triple], table: str, at: tuple[int, ...], path: str, counts: dict[str, int], listed: bool = False) -> None:
        self.read, self.out, self.table, self.at, self.path, self.counts, self.listed = read, out, table, at, path, counts, listed

    def _row(self) -> tuple[str, tuple[int, ...]] | None:
        if not self.read.extra or (whole := joined(self.table, self.path)) not in self.read.extra:
            return None
        self.counts[whole] = self.counts.get(whole, 0) + 1
        below = (*self.at, self.counts[whole])
        self.out.append((whole, below, "", None))
        return whole, below

    def scalar(self, value: str | None, string: bool) -> None:
        table, at, path = self.table, self.at, self.path
        if row := self._row():
            if value is None:
                return
            (table, at), path = row, OWN
        self.out.append((table, at, path, "" if value is None else value.strip()))
        if self.read.seen is not None:
            self.read.seen.note("leaf", table, path)

    def object(self) -> _Skip:
        if row := self._row():
            return _Fields(self.read, self.out, *row, 0)
        if self.read.seen is not None:
            whole = joined(self.table, self.path)
            self.read.seen.note("object", "", whole)
            if self.listed:
                self.read.seen.note("repeated", "", whole)
        return self

    def key(self, name: str) -> _Leaf:
        return _Leaf(self.read, self.out, self.table, self.at, joined(self.path, name), self.counts)

    def list(self) -> _Leaf:
        return self

    def item(self) -> _Leaf:
        return _Leaf(self.read, self.out, self.table, self.at, self.path, self.counts, True)


class _Fields(_Skip):
    """The object of an entry."""

    def __init__(self, read: _Read, out: list[Triple], table: str, at: tuple[int, ...], level: int) -> None:
        self.read, self.out, self.table, self.at, self.level = read, out, table, at, level
        self.counts: dict[str, int] = {}

    def key(self, name: str) -> _Skip:
        nest, level = self.read.nest, self.level
        if 0 < level < len(nest) and name == nest[level][0]:
            return _Entries(self.read, self.out, joined(self.table, *nest[level]), self.at, level + 1, self.counts)
        return _Leaf(self.read, self.out, self.table, self.at, name, self.counts)

    def leaf(self, name: str, value: str, string: bool) -> None:
        nest, level = self.read.nest, self.level
        if self.read.extra or (0 < level < len(nest) and name == nest[level][0]):
            self.key(name).scalar(value, string)
            return
        self.out.append((self.table, self.at, name, value.strip()))
        if self.read.seen is not None:
            self.read.seen.note("leaf", self.table, name)


class _Entries(_Skip):
    """The entries of a declared level in any of their spellings: a list, an object around one, one entry, nothing, or these as text.

    Numbers and other texts in place of a list are none.
    """

    def __init__(self, read: _Read, out: list[Triple], table: str, above: tuple[int, ...], level: int, counts: dict[str, int], named: bool = False) -> None:
        self.read, self.out, self.table, self.above, self.level, self.counts = read, out, table, above, level, counts
        self.named = named  # called as an entry, so an object is one and not around any

    def next(self) -> tuple[int, ...]:
        self.counts[self.table] = self.counts.get(self.table, 0) + 1
        at = (*self.above, self.counts[self.table])
        self.out.append((self.table, at, "", None))
        return at

    def scalar(self, value: str | None, string: bool) -> None:
        if string:
            if value.lstrip()[:1] in ("{", "["):
                size, counts = len(self.out), dict(self.counts)
                try:
                    _stream_all(value, _Entries(self.read, self.out, self.table, self.above, self.level, self.counts))
                except ValueError:  # text, no list
                    del self.out[size:]
                    self.counts.clear()
                    self.counts.update(counts)
        elif self.named and value in ("true", "false"):
            _One(self).scalar(value, False)

    def object(self) -> _Skip:
        return _One(self).object() if self.named else _Around(self)

    def list(self) -> _Skip:
        return self

    def item(self) -> _Skip:
        return _One(self)


class _One(_Skip):
    """One entry of a list."""

    def __init__(self, entries: _Entries) -> None:
        self.entries = entries

    def scalar(self, value: str | None, string: bool) -> None:
        if value is not None:
            e = self.entries
            _Leaf(e.read, e.out, e.table, e.next(), OWN, {}).scalar(value, string)

    def object(self) -> _Skip:
        e = self.entries
        return _Fields(e.read, e.out, e.table, e.next(), e.level)

    def list(self) -> _Skip:
        self.entries.next()
        return _SKIP


class _Around(_Skip):
    """An object that is one entry, or the one around a list of them, which its names tell: both readings are kept until then."""

    def __init__(self, entries: _Entries) -> None:
        self.entries = e = entries
        self.name = e.read.nest[e.level - 1][1]
        self.names = 0
        self.around = False
        self.counts = dict(e.counts)
        self.listed: list[Triple] = []
        self.single = _Entries(e.read, [], e.table, e.above, e.level, dict(e.counts))
        self.fields = _One(self.single).object()

    def key(self, name: str) -> _Skip:
        self.names += 1
        e = self.entries
        if name == self.name and not self.around:
            self.around = True
            return _Entries(e.read, self.listed, e.table, e.above, e.level, self.counts, True)
        return _SKIP if self.around else self.fields.key(name)

    def close(self) -> None:
        e = self.entries
        if self.around or self.names:
            e.out.extend(self.listed if self.around else self.single.out)
            e.counts.update(self.counts if self.around else self.single.counts)


class _Search(_Skip):
    """Looks for the outermost list of entries, the first of its depth, also in objects that are written as text."""

    def __init__(self, read: _Read, depth: int) -> None:
        self.read, self.depth = read, depth

    def object(self) -> _Search:
        return self

    def key(self, name: str) -> _Skip:
        read = self.read
        if name == read.nest[0][0]:
            if self.depth >= read.rank:
                return _SKIP
            read.rank = self.depth
            read.out.clear()
            return _Entries(read, read.out, "", (), 1, {})
        return _Search(read, self.depth + 1)

    def list(self) -> _Skip:
        return _SKIP if self.depth else _Entries(self.read, self.read.out, "", (), 1, {})

    def scalar(self, value: str | None, string: bool) -> None:
        if string and value.lstrip()[:1] == "{":
            kept, rank = list(self.read.out), self.read.rank
            try:
                _stream_all(value, _Search(self.read, self.depth))
            except ValueError:  # text, no object
                self.read.out[:], self.read.rank = kept, rank


def _json_triples(text: str, nest: tuple[tuple[str, str], ...], extra: frozenset[str], seen: Seen | None) -> list[Triple]:
    read = _Read(nest, extra, seen, [])
    _stream_all(text.lstrip("\ufeff"), _Search(read, 0))
    return read.out


def triples(payload: str | None, nest: tuple[tuple[str, str], ...] = NEST, extra: frozenset[str] = frozenset(), seen: Seen | None = None) -> list[Triple] | None:
    """The triples of a payload, the entry itself first with an empty path; None if it is not well-formed.

    ``extra`` has the repeated paths beyond ``nest`` that are tables. Null, empty and blank payloads and
    payloads that are neither XML nor JSON are not well-formed. Empty leaves have an empty text, as JSON
    nulls have. The depth of nesting that JSON may have is Python's limit; deeper payloads count as not
    well-formed.
    """
    head = (payload or "").lstrip("\ufeff \t\r\n")[:1]
    try:
        if head == "<":
            return _xml_triples(payload.lstrip("\ufeff \t\r\n"), nest, extra, seen)
        if head in ("{", "["):
            return _json_triples(payload, nest, extra, seen)
    except (expat.ExpatError, ValueError, RecursionError):
        pass
    return None


def pivot(found: list[Triple]) -> dict[tuple[str, tuple[int, ...]], dict[str, list[str]]]:
    """The row of each entry, by table and ordinals: by path, its values in the order of the payload."""
    rows: dict[tuple[str, tuple[int, ...]], dict[str, list[str]]] = {}
    for table, at, path, value in found:
        row = rows.setdefault((table, at), {})
        if path:
            row.setdefault(path, []).append(value)
    return rows


def declared(nest: tuple[tuple[str, str], ...] = NEST, tables: tuple[str, ...] = TABLES) -> dict[str, str]:
    """The names of the declared tables by the whole path of their entries below an item."""
    return {"/".join(f"{wrap}/{entry}" for wrap, entry in nest[1 : n + 1]): name for n, name in enumerate(tables)}


@dataclass(frozen=True)
class Layout:
    """The tables of a collection of records: their fields by table, and the table above each. Tables go by their whole path below an item."""

    fields: dict[str, tuple[str, ...]]
    parents: dict[str, str | None]

    @property
    def extra(self) -> frozenset[str]:
        return frozenset(self.parents) - declared().keys()


def layout_of(found: Iterable[tuple[str, str, str]], nest: tuple[tuple[str, str], ...] = NEST) -> Layout:
    """The layout out of what ``discover`` met: paths that are both repeated and hold elements are tables of their own."""
    known = set(found)
    paths = {what: {p for w, _, p in known if w == what} for what in ("repeated", "object")}
    levels = list(declared(nest))
    extra = paths["repeated"] & paths["object"]
    fields: dict[str, set[str]] = {t: set() for t in [*levels, *extra]}
    for _, table, path in (k for k in known if k[0] == "leaf"):
        whole, below = joined(table, path), table
        for t in extra:
            if (whole == t or whole.startswith(t + "/")) and len(t) > len(below):
                below = t
        fields[below].add(OWN if whole == below else whole[len(below) + 1 :] if below else whole)
    above = {t: max((p for p in fields if p != t and (not p or t.startswith(p + "/"))), key=len, default=None) for t in fields}
    return Layout({t: tuple(sorted(f)) for t, f in fields.items()}, above)


def discover(df: DataFrame, payload: str, nest: tuple[tuple[str, str], ...] = NEST) -> Layout:
    """The ``Layout`` of all records of a table. Each task tells every path once; payloads that are not well-formed tell nothing.

    The driver reads the different paths. Where names are data (ids as names) there may be as many as
    records; ``flatten`` without a layout keeps those as the keys of a map.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[str, str, str]] = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen = Seen()
                if triples(text, nest, seen=seen) is not None:
                    told |= seen.found
        what, table, path = zip(*sorted(told), strict=True) if told else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(what, pa.string()), pa.array(table, pa.string()), pa.array(path, pa.string())], ["what", "table", "path"])

    found = df.select(payload).mapInArrow(run, "what string, table string, path string").distinct()
    return layout_of((tuple(r) for r in found.collect()), nest)


def entries(df: DataFrame, row_id: str, payload: str, nest: tuple[tuple[str, str], ...] = NEST) -> DataFrame:
    """One row per entry of any level: ``row_id``, its number in each level (0 below its own), its ``leaves``.

    A leaf has its whole ``path`` below the item, its ``value`` and ``value_no``, its number among
    the values of that path in the entry. Payloads that are not well-formed give no rows, entries
    without values neither.
    """
    numbers = [f"{entry}_no" for _, entry in nest]
    schema = f"`{row_id}` {dict(df.dtypes)[row_id]}, " + ", ".join(f"`{n}` long" for n in numbers) + ", leaves array<struct<path:string,value_no:long,value:string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                source, at, ends, paths, places, values = [], [[] for _ in nest], [0], [], [], []
                for row_no, text in enumerate(part.column(1).to_pylist()):
                    for (table, where), row in pivot(triples(text, nest) or []).items():
                        if row:
                            source.append(row_no)
                            for n, numbers_of in enumerate(at):
                                numbers_of.append(where[n] if n < len(where) else 0)
                            for path, found in row.items():
                                whole = f"{table}/{path}" if table else path
                                paths.extend([whole] * len(found))
                                places.extend(range(1, len(found) + 1))
                                values.extend(found)
                            ends.append(len(paths))
                leaves = pa.StructArray.from_arrays([pa.array(paths, pa.string()), pa.array(places, pa.int64()), pa.array(values, pa.string())], ["path", "value_no", "value"])
                columns = [part.column(0).take(pa.array(source, pa.int64())), *(pa.array(a, pa.int64()) for a in at), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), leaves)]
                yield pa.RecordBatch.from_arrays(columns, [row_id, *numbers, "leaves"])

    return df.select(row_id, payload).mapInArrow(run, schema)


def unreadable(df: DataFrame, columns: list[str], payload: str) -> DataFrame:
    """``columns`` and ``problem`` of the records whose payload is missing, blank or not well-formed."""
    types = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(columns)).to_pylist()
            bad = [(n, "not well-formed" if (text or "").strip() else "no content") for n, text in enumerate(texts) if triples(text) is None]
            at = pa.array([n for n, _ in bad], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(len(columns))), pa.array([p for _, p in bad], pa.string())], [*columns, "problem"])

    return df.select(*columns, payload).mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in columns) + ", problem string")


def flatten(df: DataFrame, row_id: str, payload: str, fields: bool = True, layout: Layout | None = None, nest: tuple[tuple[str, str], ...] = NEST, tables: tuple[str, ...] = TABLES) -> DataFrame:
    """One row per entry of each level: ``row_id``, its table, its number in each declared level (0 below its own), its fields.

    ``fields`` maps each path to its value; several values of a path become a JSON list. Without
    ``fields`` the column is left out. With a ``layout`` every repeated ancestor has a table of its
    own, called by its whole path, and ``ordinals`` has the numbers of an entry in all tables above
    and its own; without its last it is the ``ordinals`` of the entry's parent. Payloads that are not
    well-formed and those without entries give no rows; repeated records give their rows again. Other
    columns of ``df`` are dropped.
    """
    numbers = [f"{entry}_no" for _, entry in nest]
    kind = dict(df.dtypes)[row_id]
    extra = layout.extra if layout else frozenset()
    columns = [("ordinals", "array<long>", pa.list_(pa.int64()))] * (layout is not None) + [("fields", "map<string,string>", pa.map_(pa.string(), pa.string()))] * fields
    schema = f"`{row_id}` {kind}, level_table string, " + ", ".join([*(f"`{n}` long" for n in numbers), *(f"{n} {t}" for n, t, _ in columns)])
    called = declared(nest, tables)
    depths = {table: depth for depth, table in enumerate(called, 1)}
    for table in sorted(extra, key=len):
        depths[table] = max((d for t, d in depths.items() if t in called and (not t or table.startswith(t + "/"))), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                ids, levels, at, more = [], [], [[] for _ in nest], {n: [] for n, _, _ in columns}
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for (table, where), row in pivot(triples(text, nest, extra) or []).items():
                        ids.append(key)
                        levels.append(called.get(table, table))
                        for n, numbers_of in enumerate(at):
                            numbers_of.append(where[n] if n < depths[table] else 0)
                        if layout:
                            more["ordinals"].append(where)
                        if fields:
                            more["fields"].append([(k, v[0] if len(v) == 1 else json.dumps(v, ensure_ascii=False)) for k, v in row.items()])
                arrays = [pa.array(ids, part.schema.field(0).type), pa.array(levels, pa.string()), *(pa.array(a, pa.int64()) for a in at), *(pa.array(more[n], t) for n, _, t in columns)]
                yield pa.RecordBatch.from_arrays(arrays, [row_id, "level_table", *numbers, *(n for n, _, _ in columns)])

    return df.select(row_id, payload).mapInArrow(run, schema)


def level(flat: DataFrame, name: str) -> DataFrame:
    """The table of one level out of ``flatten``."""
    return flat.filter(flat.level_table == name).drop("level_table")


def table_of(df: DataFrame, row_id: str, payload: str, layout: Layout, path: str, nest: tuple[tuple[str, str], ...] = NEST) -> DataFrame:
    """The table at ``path`` of a layout: ``row_id``, the numbers and ``ordinals`` of ``flatten``, and a column for each of its fields.

    Names that differ in letter case only are one column, in the spelling that sorts first, whose value
    comes first too; a field that is called like a link column gets ``_field`` behind its name. Several
    values of a field become a JSON list.
    """
    numbers = [f"{entry}_no" for _, entry in nest]
    taken = {c.lower() for c in (row_id, *numbers, "ordinals")}
    columns: dict[str, str] = {}  # by field
    called: dict[str, str] = {}
    for name in layout.fields[path]:
        columns[name] = called.setdefault(name.lower(), name + "_field" * (name.lower() in taken))
    merged = len(called) < len(columns)
    names = [*called.values()]
    depth = max(d for d, t in enumerate(declared(nest), 1) if not t or path == t or path.startswith(t + "/"))
    kind = dict(df.dtypes)[row_id]
    quoted = ["`" + c.replace("`", "``") + "`" for c in names]
    schema = f"`{row_id}` {kind}, " + ", ".join([*(f"`{n}` long" for n in numbers), "ordinals array<long>", *(f"{c} string" for c in quoted)])
    shape = pa.struct([(c, pa.string()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                source, ordinals, rows = [], [], []
                for row_no, text in enumerate(part.column(1).to_pylist()):
                    for (table, where), row in pivot(triples(text, nest, layout.extra) or []).items():
                        if table == path:
                            source.append(row_no)
                            ordinals.append(where)
                            held: dict[str, str] = {}
                            for field in sorted(row) if merged else row:
                                values = row[field]
                                held.setdefault(columns[field], values[0] if len(values) == 1 else json.dumps(values, ensure_ascii=False))
                            rows.append(held)
                places = [pa.array([w[n] if n < depth else 0 for w in ordinals], pa.int64()) for n in range(len(nest))]
                fields = pa.array(rows, shape).flatten() if names else []
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(source, pa.int64())), *places, pa.array(ordinals, pa.list_(pa.int64())), *fields], [row_id, *numbers, "ordinals", *names])

    return df.select(row_id, payload).mapInArrow(run, schema)
