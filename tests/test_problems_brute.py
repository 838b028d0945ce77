"""The queries of nested and drifting payloads against plain recomputations of the smallest tables."""

from __future__ import annotations

import json
import posixpath
import re
import xml.etree.ElementTree as ET
from collections import defaultdict

import pytest

from comparison import DATA
from json_tree import tree_triples
from tallyloom.operators.nested import NEST, unreadable
from tallyloom.plans.problems import QUERIES

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def plain(name):
    return re.sub(r"^\{[^}]*\}|^[^:]*:", "", name.strip()).strip()


def xml_rows(element, level, path, at, out):
    """The leaves of one entry by whole path, and those of the entries below."""
    wrap, entry = NEST[level] if level < 3 else (None, None)

    def below(node, names):
        numbers = 0
        for child in node:
            name = plain(child.tag)
            if level < 3 and not names and name == wrap:
                for one in child:
                    if plain(one.tag) == entry:
                        numbers += 1
                        out[(*at, numbers)] += []
                        xml_rows(one, level + 1, [*path, wrap, entry], (*at, numbers), out)
            elif len(child):
                below(child, [*names, name])
            else:
                out[at].append(("/".join([*path, *names, name]), (child.text or "").strip()))

    below(element, [])


def rows_of(payload):
    """By ordinals: the leaves of each entry; None for what cannot be read."""
    out = defaultdict(list)
    text = (payload or "").lstrip("﻿ \t\r\n")
    try:
        if text[:1] == "<":
            root = ET.fromstring(text.encode() if "encoding" in text[:80] else text)
            number = 0

            def find(node):
                nonlocal number
                for child in node:
                    if plain(child.tag) == "item":
                        number += 1
                        out[(number,)] += []
                        xml_rows(child, 1, [], (number,), out)
                    else:
                        find(child)

            find(root)
            return out
        if text[:1] in ("{", "["):
            json.loads(text)
            for table, at, path, value in tree_triples(text, NEST, frozenset()):
                out[at] += [(f"{table}/{path}" if table else path, value)] if path else []
            return out
    except (ET.ParseError, ValueError):
        pass
    return None


def spelled(path):
    text = re.sub(r"^(?i:file):(?://(?:localhost)?(?=/))?", "", path.strip().replace("\\", "/"))
    whole = posixpath.normpath(text if text.startswith("/") else f"/srv/collector/{text}")
    return re.sub(r"^/+srv/collector/", "", whole)


@pytest.fixture(scope="module")
def tables(spark):
    responses = spark.read.parquet(str(DATA / "raw_responses.parquet")).select("response_id", "raw_path", "payload").collect()
    manifest = spark.read.parquet(str(DATA / "manifest_records.parquet")).select("service", "operation", "raw_path", "params", "field_names").collect()
    return responses, manifest


def test_entries(spark, tables):
    wanted = sorted((r.response_id, *at, *[0] * (3 - len(at))) for r in tables[0] for at in rows_of(r.payload) or ())
    assert sorted(tuple(r) for r in QUERIES["p5_found"](spark, str(DATA)).collect()) == wanted


def test_every_field_is_a_column(spark, tables):
    for name, size, prefix in (("p5_items", 1, ""), ("p5_majors", 2, "majorList/major/"), ("p5_quotas", 3, "majorList/major/quotaList/quota/")):
        numbers = ["response_id", "item_no", "major_no", "quota_no"][: size + 1]
        wanted = {}
        for r in tables[0]:
            for at, leaves in (rows_of(r.payload) or {}).items():
                if len(at) == size:
                    row = wanted[(r.response_id, *at)] = defaultdict(list)
                    for path, value in leaves:
                        row[path.removeprefix(prefix)].append(value)
        for row in QUERIES[name](spark, str(DATA)).collect():
            held = row.asDict()
            key = tuple(held.pop(n) for n in numbers)
            found = {k: v for k, v in held.items() if v is not None}
            assert found == {k: v[0] if len(v) == 1 else json.dumps(v, ensure_ascii=False) for k, v in wanted.pop(key).items()}, key
        assert not wanted


def test_kinds_by_year(spark, tables):
    payloads = defaultdict(list)
    for r in tables[0]:
        if r.raw_path is not None:
            payloads[spelled(r.raw_path)].append(rows_of(r.payload) or {})
    kinds = defaultdict(set)
    for m in tables[1]:
        year = (m.params or {}).get("svyYr")
        if year and m.field_names and m.raw_path is not None:
            for entries in payloads.get(spelled(m.raw_path), ()):
                for leaves in entries.values():
                    for path, value in leaves:
                        if value not in ("", "-"):
                            kind = "integer" if re.fullmatch(r"[+-]?[0-9]+", value) else "decimal" if re.fullmatch(r"[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+)", value) else "date" if re.fullmatch(r"\d{4}-\d{2}-\d{2}", value) else "text"
                            kinds[m.service, m.operation, int(year), path.lower()].add(kind)
    found = {(r.service, r.operation, r.survey_year, r.field): set(r.alternatives.split(",")) for r in QUERIES["p1_schema"](spark, str(DATA)).filter("alternatives <> ''").collect()}
    assert found == dict(kinds)


def test_unified_holds_every_leaf(spark, tables):
    leaves = sum(len(row) for r in tables[0] for row in (rows_of(r.payload) or {}).values())
    unified = QUERIES["p1_unified"](spark, str(DATA))
    files = {}
    for m in tables[1]:
        if m.raw_path is not None:
            files.setdefault(spelled(m.raw_path), set()).add((m.service, m.operation, (m.params or {}).get("svyYr")))
    times = sum(len(row) * max(1, len(files.get(spelled(r.raw_path), ()) if r.raw_path is not None else ())) for r in tables[0] for row in (rows_of(r.payload) or {}).values())
    assert unified.count() == times >= leaves > 0


def test_unreadable(spark, rows):
    df = spark.createDataFrame([(1, "<a/>"), (2, "<a>"), (3, None), (4, "  "), (5, "text"), (None, '{"a": 1}'), (None, "{")], "response_id long, payload string")
    assert rows(unreadable(df, ["response_id"], "payload")) == sorted([(2, "not well-formed"), (3, "no content"), (4, "no content"), (5, "not well-formed"), (None, "not well-formed")], key=repr)
    assert unreadable(df.limit(0), ["response_id"], "payload").count() == 0
