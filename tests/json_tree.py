"""The triples of JSON payloads out of the whole tree: what the streaming parser is compared with."""

from __future__ import annotations

import json
from typing import Any

from tallyloom.operators.nested import OWN, Triple, joined, local_name


def _no_constant(name: str) -> None:
    raise ValueError(name)


def _entries(value: Any, entry: str) -> list:
    """The entries of a list in any of its spellings: a list, an object around one, one entry, nothing."""
    if isinstance(value, str):
        value = _inner_json(value)
    if isinstance(value, dict):
        inside = [v for k, v in value.items() if local_name(k) == entry]
        if inside:
            return _entries(inside[0], entry) if isinstance(inside[0], (list, str)) or inside[0] is None else [inside[0]]
        return [value] if value else []
    if isinstance(value, list):
        return [v for v in value if v is not None]
    return []


def _inner_json(text: str) -> Any:
    """A JSON object or list that is written as text; any other text is None."""
    try:
        return json.loads(text, parse_float=str, parse_int=str, parse_constant=_no_constant) if text.lstrip()[:1] in ("{", "[") else None
    except ValueError:
        return None


def _find(value: Any, name: str) -> Any:
    """The first value called ``name`` in objects, outermost first, also in objects written as text."""
    level = [value]
    while level:
        below = []
        for v in level:
            if isinstance(v, str):
                v = _inner_json(v)
            if isinstance(v, dict):
                for k, x in v.items():
                    if local_name(k) == name:
                        return x
                    below.append(x)
        level = below
    return None


def tree_triples(text: str, nest: tuple[tuple[str, str], ...], extra: frozenset[str]) -> list[Triple]:
    root = json.loads(text.lstrip("\ufeff"), parse_float=str, parse_int=str, parse_constant=_no_constant)
    out: list[Triple] = []

    def leaf(table: str, at: tuple[int, ...], path: str, value: Any) -> None:
        out.append((table, at, path, "" if value is None else str(value).lower() if isinstance(value, bool) else str(value).strip()))

    def inside(value: Any, path: str, table: str, at: tuple[int, ...], counts: dict[str, int]) -> None:
        if isinstance(value, list):
            for v in value:
                inside(v, path, table, at, counts)
            return
        whole = joined(table, path)
        if extra and whole in extra:
            counts[whole] = counts.get(whole, 0) + 1
            below = (*at, counts[whole])
            out.append((whole, below, "", None))
            if isinstance(value, dict):
                fields(value, whole, below, 0)
            elif value is not None:
                leaf(whole, below, OWN, value)
        elif isinstance(value, dict):
            for k, v in value.items():
                inside(v, joined(path, local_name(k)), table, at, counts)
        else:
            leaf(table, at, path, value)

    def fields(one: dict, table: str, at: tuple[int, ...], level: int) -> None:
        counts: dict[str, int] = {}
        for k, v in one.items():
            name = local_name(k)
            if 0 < level < len(nest) and name == nest[level][0]:
                walk(_entries(v, nest[level][1]), joined(table, *nest[level]), at, level + 1)
            else:
                inside(v, name, table, at, counts)

    def walk(entries: list, table: str, above: tuple[int, ...], level: int) -> None:
        for n, one in enumerate(entries, 1):
            at = (*above, n)
            out.append((table, at, "", None))
            if isinstance(one, dict):
                fields(one, table, at, level)
            elif not isinstance(one, list):
                leaf(table, at, OWN, one)

    found = root if isinstance(root, list) else _find(root, nest[0][0])
    walk(_entries(found, nest[0][1]), "", (), 1)
    return out


