from __future__ import annotations

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from json_tree import tree_triples
from tallyloom.operators.nested import NEST, discover, elements, flatten, level, pivot, table_of, triples

ITEM = st.fixed_dictionaries({"a": st.text("xy<&", max_size=3), "majors": st.none() | st.lists(st.fixed_dictionaries({"n": st.text("pq", min_size=1, max_size=2), "quotas": st.none() | st.lists(st.integers(0, 9), max_size=3)}), max_size=3), "rmk": st.none() | st.lists(st.text("rs", min_size=1, max_size=2), max_size=2)})


def wanted(items):
    out = set()
    for i, item in enumerate(items, 1):
        out.add((i,))
        for j, major in enumerate(item["majors"] or (), 1):
            out.add((i, j))
            out |= {(i, j, k) for k in range(1, len(major["quotas"] or ()) + 1)}
    return out


def as_xml(items, prefix=""):
    p = prefix and prefix + ":"
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;")
    body = ""
    for item in items:
        body += f"<{p}item><{p}a>{esc(item['a'])}</{p}a>"
        if item["majors"] is not None:
            body += f"<{p}majorList>" + "".join(f"<{p}major><{p}n>{m['n']}</{p}n>" + (f"<{p}quotaList>" + "".join(f"<{p}quota><{p}grd>{q}</{p}grd></{p}quota>" for q in m["quotas"]) + f"</{p}quotaList>" if m["quotas"] is not None else "") + f"</{p}major>" for m in item["majors"]) + f"</{p}majorList>"
        if item["rmk"] is not None:
            body += f"<{p}rmkList>" + "".join(f"<{p}item>{r}</{p}item>" for r in item["rmk"]) + f"</{p}rmkList>"
        body += f"</{p}item>"
    space = f' xmlns:{prefix}="urn:x"' if prefix else ""
    return f"<{p}response{space}><{p}body><{p}items>{body}</{p}items></{p}body></{p}response>"


def as_json(items, bare, inner):
    def spell(entries, name):
        if entries is None:
            return None
        if bare:
            return entries or ""
        return {name: entries[0] if len(entries) == 1 else entries}

    out = [{"a": i["a"], "majorList": spell(None if i["majors"] is None else [{"n": m["n"], "quotaList": spell(None if m["quotas"] is None else [{"grd": q} for q in m["quotas"]], "quota")} for m in i["majors"]], "major"), "rmkList": {"item": i["rmk"] or []}} for i in items]
    body = {"items": spell(out, "item"), "totalCount": len(items)}
    return json.dumps({"response": {"header": {"resultMsg": "[OK] {fine}"}, "body": json.dumps(body) if inner else body}})


@settings(max_examples=150, deadline=None)
@given(st.lists(ITEM, max_size=3), st.booleans(), st.booleans())
def test_shapes(items, flag, inner):
    for text in (as_xml(items), as_xml(items, "c"), as_json(items, flag, inner)):
        rows = pivot(triples(text))
        assert {at for _, at in rows} == wanted(items)
        assert {table for table, _ in rows} <= {"", "majorList/major", "majorList/major/quotaList/quota"}
        for i, item in enumerate(items, 1):
            assert rows["", (i,)]["a"] == [item["a"].strip()]
            assert rows["", (i,)].get("rmkList/item", []) == (item["rmk"] or [])


def test_cut_payloads():
    whole = as_xml([{"a": "x", "majors": [{"n": "p", "quotas": [1, 2]}], "rmk": ["r"]}])
    assert all(triples(whole[:n]) is None for n in range(len(whole)))
    text = as_json([{"a": "x", "majors": [], "rmk": []}], True, False)
    assert all(triples(text[:n]) is None for n in range(len(text)))
    assert triples(None) is None and triples("  ") is None and triples("plain") is None
    assert triples('{"a": NaN}') is None and triples("[" * 100_000) is None
    assert triples('{"response": {"body": {"totalCount": 0}}}') == []


def test_long_payload():
    items = "".join(f"<item><a>{n}</a></item>" for n in range(20_000))
    assert len(pivot(triples(f"<r><items>{items}</items></r>"))) == 20_000


def test_flatten(spark, rows):
    xml = as_xml([{"a": "1", "majors": [{"n": "p", "quotas": [7]}], "rmk": ["r", "s"]}])
    df = spark.createDataFrame([(1, xml), (1, xml), (2, None), (3, "<broken>"), (None, as_xml([{"a": "", "majors": None, "rmk": None}]))], "response_id long, payload string")
    flat = flatten(df.withColumns({"fields": F.lit(1), "item_no": F.lit(5)}), "response_id", "payload")
    one = [(1, "items", 1, 0, 0), (1, "majors", 1, 1, 0), (1, "quotas", 1, 1, 1)]
    assert rows(flat.drop("fields")) == sorted([*one, *one, (None, "items", 1, 0, 0)], key=repr)
    first = level(flat, "items").filter("response_id = 1").first()
    assert first.fields == {"a": "1", "rmkList/item": '["r", "s"]'}
    assert level(flat, "quotas").first().fields == {"grd": "7"}
    assert flatten(df.limit(0), "response_id", "payload", fields=False).count() == 0


KIDS = "<r><items><item><a>1</a><kids><kid><x>1</x></kid><kid><y>2</y><pet><n>p</n></pet><pet><n>q</n></pet></kid></kids></item><item><kids><kid>plain</kid></kids><rmk><item>r</item><item>s</item></rmk></item></items></r>"


def test_repeated_lists_become_tables(spark, rows):
    texts = [(1, KIDS), (2, '{"items": [{"a": "2", "kids": {"kid": {"X": "7", "item_no": "n"}}, "A": "3"}]}'), (3, "<broken>"), (4, None)]
    df = spark.createDataFrame(texts, "response_id long, payload string").withColumns({"ordinals": F.lit(1), "fields": F.lit(2)})
    layout = discover(df, "payload")
    assert layout.extra == {"kids/kid", "kids/kid/pet"} and layout.parents["kids/kid/pet"] == "kids/kid" and layout.parents["kids/kid"] == ""
    assert layout.fields[""] == ("A", "a", "rmk/item") and layout.fields["kids/kid"] == ("#text", "X", "item_no", "x", "y")
    flat = flatten(df, "response_id", "payload", layout=layout)
    assert rows(flat, "response_id", "level_table", "item_no", "major_no", "ordinals") == sorted([
        (1, "items", 1, 0, [1]), (1, "kids/kid", 1, 0, [1, 1]), (1, "kids/kid", 1, 0, [1, 2]), (1, "kids/kid/pet", 1, 0, [1, 2, 1]), (1, "kids/kid/pet", 1, 0, [1, 2, 2]),
        (1, "items", 2, 0, [2]), (1, "kids/kid", 2, 0, [2, 1]), (2, "items", 1, 0, [1]), (2, "kids/kid", 1, 0, [1, 1]),
    ], key=repr)
    kids = table_of(df, "response_id", "payload", layout, "kids/kid")
    assert kids.columns == ["response_id", "item_no", "major_no", "quota_no", "ordinals", "#text", "X", "item_no_field", "y"]
    assert rows(kids, "`#text`", "X", "item_no_field", "y") == sorted([(None, "1", None, None), (None, None, None, "2"), ("plain", None, None, None), (None, "7", "n", None)], key=repr)
    assert rows(table_of(df, "response_id", "payload", layout, ""), "A", "`rmk/item`") == sorted([("1", None), (None, '["r", "s"]'), ("3", None)], key=repr)
    pets = table_of(df, "response_id", "payload", layout, "kids/kid/pet")
    assert rows(pets) == [(1, 1, 0, 0, [1, 2, 1], "p"), (1, 1, 0, 0, [1, 2, 2], "q")]
    empty = discover(df.limit(0), "payload")
    assert table_of(df.limit(0), "response_id", "payload", empty, "").columns == ["response_id", "item_no", "major_no", "quota_no", "ordinals"]
    assert table_of(df.limit(0), "response_id", "payload", empty, "").count() == 0
    assert empty.extra == frozenset() and flatten(df.limit(0), "response_id", "payload", layout=empty).count() == 0


def test_elements():
    assert list(elements("<r> x <a>1</a><a> 2<b/>3</a></r>")) == [(("r",), (1,), "x"), (("r", "a"), (1, 1), "1"), (("r", "a"), (1, 2), "2"), (("r", "a", "b"), (1, 2, 1), "")]
    assert len(list(elements("<r>" + "<a>가</a>" * 50_000 + "</r>"))) == 50_001


JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 99) | st.floats(allow_nan=False, allow_infinity=False) | st.text('ab {["é' + chr(92), max_size=3),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["items", "item", "majorList", "major", "quotaList", "c:quota", "kids", "a", "b"]), inner, max_size=4),
    max_leaves=14,
)


@settings(max_examples=400, deadline=None)
@given(JSON, st.sampled_from([None, 1]), st.booleans())
def test_streamed_like_the_tree(value, indent, as_text):
    document = {"response": {"body": json.dumps(value) if as_text else value}, "items": value} if isinstance(value, int) else {"r": {"body": json.dumps(value) if as_text else value, "items": value}, "q": value}
    text = json.dumps(document, indent=indent)
    for extra in (frozenset(), frozenset({"kids", "a", "majorList/major/kids", "b/a"})):
        assert triples(text, extra=extra) == tree_triples(text, NEST, extra)
    for n in range(0, len(text), 3):
        assert triples(text[:n]) is None


def test_what_is_no_json():
    for text in ('{"a": 01}', '{"a": 1,}', '{"a" 1}', '{"a": .5}', '[1 2]', '{"a": "\n"}', '{"a": Infinity}', '{a: 1}', '{"a": tru}', '{"items": []} x', '{"a": "\\x"}', "[1,]", '{"a": 1.}', '{"a": -}'):
        assert triples(text) is None, text
    assert triples('{"items": {"a": 1, "a": 2}}') == [("", (1,), "", None), ("", (1,), "a", "1"), ("", (1,), "a", "2")]
