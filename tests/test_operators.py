"""Planning, manifests, profiles, contracts and reconciliation on small fixtures."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import ids, text
from tallyloom.model import ENDPOINTS
from tallyloom.operators import contracts, manifest, planning, profiles, reconcile, skew, summaries

ERROR = "USER_RAISED_EXCEPTION"


def catalogue(spark, *rows):
    return spark.createDataFrame([("d", s, o, strategy, f"https://x.example/{o}", ["v"], fixed) for s, o, strategy, fixed in rows], ENDPOINTS)


def dimensions(spark, years, schools, divisions=()):
    return (spark.createDataFrame([(y,) for y in years], "svyYr string"), spark.createDataFrame(schools, "svyYr string, schlId string"), spark.createDataFrame([(d,) for d in divisions], "schlDivCd string"))


def test_grid(spark):
    endpoints = catalogue(spark, *((("S", s, s, None)) for s in planning.STRATEGIES), ("S", "lookup", "lookup_once", {"rtnTp": "가"}), ("S", "lookup", "lookup_once", {"rtnTp": "가"}))
    schools = [("2025", "0000027"), ("2025", "0000027"), ("2024", "0000014"), ("2024", "0000001"), ("1999", "0000009")]
    tasks = planning.in_order(planning.expand(planning.distinct_endpoints(endpoints), *dimensions(spark, ["2025", "2024", "2025"], schools, ["02", "01", "02"]), prefix="t-")).collect()
    assert len(tasks) == 3 + 2 + 2 + 1 + 1 + 2 + 1
    for t in tasks:
        whole = {"data_id": t.data_id, "service": t.service, "operation": t.operation, "endpoint_url": t.endpoint_url, "scope_strategy": t.scope_strategy, "params": sorted(map(list, t.params.items()))}
        assert t.task_id == "t-" + hashlib.sha256(json.dumps(whole, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:24]
    per_school = [t.params for t in tasks if t.operation == "per_school_by_year"]
    assert per_school == [{"schlId": "0000001", "svyYr": "2024"}, {"schlId": "0000014", "svyYr": "2024"}, {"schlId": "0000027", "svyYr": "2025"}]


def test_grid_errors(spark):
    dims = dimensions(spark, ["2025"], [("2025", "1")])
    clash = catalogue(spark, ("S", "o", "nationwide_by_year", {"svyYr": "1"}))
    with pytest.raises(Exception, match=ERROR):
        planning.expand(clash, *dims).collect()
    assert [r.clashes for r in planning.parameter_clashes(clash).collect()] == [["svyYr"]]
    two = catalogue(spark, ("S", "o", "lookup_once", None), ("S", "o", "lookup_by_year", None))
    assert planning.catalogue_conflicts(two).count() == 1
    with pytest.raises(Exception, match=ERROR):
        planning.distinct_endpoints(two).collect()
    with pytest.raises(ValueError, match="unknown"):
        planning.select_operations(two, ["other"])
    with pytest.raises(ValueError, match="no operation"):
        planning.select_operations(two, [])
    assert planning.select_operations(two, None).count() == 2 == planning.select_operations(two, ["o"]).count()
    assert [r.svyYr for r in planning.missing_years(dimensions(spark, ["2024", "2025"], [])[0], dims[1]).collect()] == ["2024"]
    with pytest.raises(Exception, match=ERROR):
        planning.distinct_strings(spark.createDataFrame([("a",), (" ",)], "v string"), "v").collect()


def test_golden_count(spark):
    """The published size of one year's grid: 46 operations of 377 schools, 32 of 2 divisions, and the rest."""
    mix = {"per_school_by_year": 46, "regional_by_school_type": 32, "nationwide_by_year": 5, "lookup_by_year": 4, "lookup_once": 15, "regional_all_school_types": 1}
    endpoints = catalogue(spark, *(("S", f"{s}{n}", s, None) for s, count in mix.items() for n in range(count)))
    tasks = planning.expand(endpoints, *dimensions(spark, ["2025"], [("2025", f"{n:07d}") for n in range(377)], ["01", "02"]))
    assert tasks.count() == 17_431


def test_manifest(spark, rows):
    tasks = spark.createDataFrame([("a",), ("b",), (None,)], "task_id string")
    done = spark.createDataFrame([("a", 1, "x", "downloaded"), ("a", 2, "y", "downloaded"), ("a", 3, "z", "failed"), (None, 4, "x", "downloaded")], "task_id string, n int, sha256 string, status string")
    assert rows(manifest.skipped(tasks, done)) == [("a",)]
    assert rows(manifest.pending(tasks, done)) == sorted([("b",), (None,)], key=repr)
    assert rows(manifest.with_status(tasks, done)) == sorted([("a", "skipped"), ("b", "pending"), (None, "pending")], key=repr)
    assert rows(manifest.conflicts(done)) == [("a", 3)]
    assert rows(manifest.last_wins(done, "task_id", ["n"], "status = 'downloaded'"), "n") == [(2,)]
    assert rows(manifest.first_wins(done, "task_id", ["n"]), "n") == [(1,)]
    listed = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z"), ("d", None, None), ("e", 1, "x")], "file_key string, bytes long, sha256 string")
    facts = spark.createDataFrame([("a", 1, "x"), ("b", 9, "y"), ("c", 3, "q"), ("d", 5, "t")], "file_key string, fact_size long, fact_digest string")
    assert rows(manifest.verified(listed, facts), "file_key", "finding") == [("a", "verified"), ("b", "changed size"), ("c", "changed content"), ("d", "verified"), ("e", "missing")]


@pytest.mark.parametrize("case,wanted", [((1, 1, 1, 1, 0, 0), "skipped"), ((1, 1, 0, 1, 0, 0), "task conflict"), ((1, 2, 1, 1, 1, 1), "task conflict"), ((1, 1, 1, 0, 1, 1), "integrity error"), ((0, 0, 0, 0, 1, 1), "adopted"), ((0, 0, 0, 0, 1, 0), "path conflict"), ((0, 0, 0, 0, 0, 0), "stored")])
def test_publication(spark, case, wanted):
    recorded, digests, record, verifies, present, same = case
    column = manifest.publication(*(F.lit(bool(v)) if n != 1 else F.lit(v) for n, v in enumerate((recorded, digests, record, verifies, present, same))))
    assert spark.range(1).select(column).first()[0] == wanted


XML = "<response><header><resultCode/><resultCode>00</resultCode><resultMsg>OK</resultMsg></header><body><items>{}</items><totalCount>{}</totalCount></body></response>"


@pytest.mark.parametrize("items,total,wanted", [
    ("", "0", ("00", 0, 0, [], 0)),
    ("<item><schlId>01</schlId><value>1</value></item><item><schlId>01</schlId><value>1</value></item><item><schlId>1</schlId><value>1</value><note/></item>", "12", ("00", 12, 3, ["note", "schlId", "value"], 1)),
    ("<item><a/><b/></item><item><b/><a/></item><item><a/></item>", "n/a", ("00", None, 3, ["a", "b"], 0)),
    ("<item><l>t<m>x</m>tail</l></item><item><l>t</l></item>", "2", ("00", 2, 2, ["l"], 1)),
    ("<x:item xmlns:x='u'><x:a>1</x:a><x:l><x:item>2</x:item></x:l></x:item>", "1", ("00", 1, 1, ["a", "l"], 0)),
])
def test_profile(items, total, wanted):
    p = profiles.profile(XML.format(items, total))
    assert (p["result_code"], p["total_count"], p["item_count"], p["field_names"], p["duplicate_row_count"]) == wanted
    assert p["first_code"] == "" and p["all_items"] == items.count("<item>") + items.count("x:item xmlns") + items.count("<x:item>") and p["error"] is None


def test_profile_errors(spark, rows):
    df = spark.createDataFrame([(1, "<broken>"), (2, None), (3, '{"a": 1}'), (4, " <a/>")], "n int, payload string").withColumn("error", F.lit(1))
    got = rows(profiles.xml_profiles(df, "n", "payload"), "n", F.col("error").isNotNull(), "item_count")
    assert got == [(1, True, None), (4, False, 0)]


def test_exact_rows(spark, rows):
    items = "<item><a/><b>1</b></item><item><b>1</b><a/></item><item><a/><b> 1 </b></item>"
    df = spark.createDataFrame([(1, XML.format(items, 3)), (2, "<broken>"), (3, None), (4, "{}")], "n int, payload string").withColumn("pairs", F.lit(1))
    exact = profiles.exact_rows(df, "n", "payload")
    assert rows(exact.select("n", "item_no", F.to_json("pairs")))[0] == (1, 1, '[{"name":"a","value":""},{"name":"b","value":"1"}]')
    assert rows(profiles.exact_duplicates(exact, "n")) == [(1, 3, 1)]
    assert rows(profiles.same_responses(exact, exact, "n")) == [(1, True)]
    assert rows(profiles.same_responses(exact, exact.filter("item_no > 1"), "n")) == [(1, False)]


def test_rules(spark, rows):
    endpoints = catalogue(spark, ("S", "a", "lookup_once", None), ("T", "b", "lookup_once", None))
    assert contracts.catalogue_contract(endpoints, 2, 2).first().failure is None
    assert contracts.catalogue_contract(endpoints, 3, 2).first().failure == "unexpected number of operations"
    assert contracts.catalogue_contract(endpoints.union(endpoints), 4, 2).first().failure == "repeated operation"
    df = spark.createDataFrame([(0,), (1,), (None,)], "n int")
    assert rows(contracts.assertions(df, zero=F.col("n") == 0, known=F.col("n").isNotNull())) == [("known", 3, 1), ("zero", 3, 2)]
    assert contracts.exactly_one(endpoints, ["service", "operation"]).count() == 2
    with pytest.raises(Exception, match=ERROR):
        contracts.exactly_one(endpoints.union(endpoints), ["service", "operation"]).collect()


def test_scope(spark):
    df = spark.createDataFrame([("s", "2", "x"), ("s", "1", "y"), ("t", "3", "z")], "source string, domn_code string, dataset string")
    assert [r.domn_code for r in reconcile.select_scope(df, {"s": 2, "t": 1}).collect()] == ["1", "2", "3"]
    assert reconcile.select_scope(df, {"s": 9, "t": 1}, ["s"], ["2"]).count() == 1
    for bad in (({"s": 3, "t": 1},), ({"s": 2}, ["u"]), ({"s": 2}, ["s"], ["3"])):
        with pytest.raises(ValueError):
            reconcile.select_scope(df, *bad)


def test_row_digest(spark):
    pairs = [("이름", "값"), ("b", ""), ("c", None)]
    digest = hashlib.sha256()
    for p in pairs:
        for value in p:
            data = (value or "").encode()
            digest.update(len(data).to_bytes(8, "big") + data)
    df = spark.createDataFrame([(pairs,)], "p array<struct<name:string,value:string>>")
    assert df.select(ids.row_digest(F.col("p"))).first()[0] == digest.hexdigest()


def test_ascii_json(spark):
    values = ['{"a":"가😀é"}', "plain", ""]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(ids.ascii_json(F.col("v"))).collect()] == ["".join(c if ord(c) < 128 else json.dumps(c)[1:-1] for c in v) for v in values]


def test_contracts(spark, rows):
    schema = "n int, http_status int, result_code string, total_count long, item_count long"
    df = spark.createDataFrame([(1, 200, "00", 2, 2), (2, 500, None, None, None), (3, 200, "99", 0, 0), (4, 200, "00", None, 1), (5, 200, "00", 5, 4), (6, None, "00", 1, 1), (7, 200, "00", 9, 1)], schema)
    ok, bad = contracts.split(df, contracts.response_failure())
    assert rows(ok, "n") == [(1,)]
    assert rows(bad, "n", "failure") == [(2, "unexpected status"), (3, "unexpected result code"), (4, "no numeric total"), (5, "unexpected number of items"), (6, "unexpected status"), (7, "unexpected number of items")]
    probe = contracts.split(df, contracts.response_failure(expected_total=F.lit(9), page_size=F.lit(1)))
    assert rows(probe[0], "n") == [(7,)] and ("total changed",) in rows(probe[1], "failure")
    with pytest.raises(Exception, match=ERROR):
        contracts.within_limit(df, "total_count", 8).collect()
    names = spark.createDataFrame([(["a"], ["a", "b"], 1), (["x", "a"], ["a"], 1), (["a"], ["a"], 0), ([], ["a"], 0)], "f array<string>, d array<string>, n int")
    assert [r[0] for r in names.select(contracts.field_failure(F.col("f"), F.col("d"), F.col("n"))).collect()] == [None, "undeclared fields", "fields without items", None]


def test_shapes(spark):
    cases = [(["a", "b"], 2, 0, 1, None), (["b", "a"], 2, 0, 1, "unsorted field names"), (["a", "a"], 2, 0, 1, "repeated field name"), (["a", " "], 2, 0, 1, "blank field name"), (["a"], 2, 0, 1, "column count differs"), (["a"], 1, 2, 1, "duplicate count out of range"), (["a"], 1, -1, 1, "duplicate count out of range"), (["a"], 1, None, 1, "duplicate count out of range"), (None, 1, 0, 1, "no field names")]
    df = spark.createDataFrame([c[:4] for c in cases], "field_names array<string>, column_count int, duplicate_row_count long, row_count long")
    assert [r[0] for r in df.select(contracts.shape_failure()).collect()] == [c[4] for c in cases]


def test_reconcile(spark, rows):
    expected = spark.createDataFrame([("a", 2), ("b", 0), ("c", 1)], "k string, expected int")
    actual = spark.createDataFrame([("a",), ("a",), ("d",)], "k string")
    assert rows(reconcile.expected_counts(expected, actual, ["k"])) == [("a", 2, 2, True), ("b", 0, 0, True), ("c", 1, 0, False)]
    files = spark.createDataFrame([(1, "g", "x"), (2, "g", "?"), (3, "other", "x"), (4, None, None)], "n int, g string, l string")
    series = spark.createDataFrame([("g", "x", "id1")], "g string, l string, id string")
    assert rows(reconcile.mapped(files, series, "g", "l"), "n", "mapping", "id") == [(1, "mapped", "id1"), (2, "unmapped", None)]
    assert rows(reconcile.unknown(spark.createDataFrame([("a",), ("z",), ("z",)], "k string"), actual, "k")) == [("z",)]
    assert rows(reconcile.same_set(actual, expected, "k")) == [(1, 2, False)]
    assert rows(reconcile.repeated(actual, ["k"])) == [("a", 2)]
    a, b = spark.range(500).toDF("row_id"), spark.range(487, 987).toDF("row_id")
    assert reconcile.common_rows(a, b).count() == 13
    assert reconcile.filtered(files, g=["g"], n=None).count() == 2
    with pytest.raises(ValueError, match="unknown"):
        reconcile.filtered(files, g=["nowhere"])
    with pytest.raises(ValueError, match="select nothing"):
        reconcile.filtered(files, g=["other"], n=[1])


def test_join_unique(spark, rows):
    left = spark.createDataFrame([("hot", n) for n in range(50)] + [("a", 1), ("b", 2), (None, 3)], "k string, n int")
    right = spark.createDataFrame([("hot", "x"), ("a", "y"), ("c", "z"), (None, "w")], "k string, v string")
    for how in ("left", "inner"):
        assert rows(skew.join_unique(left, right, ["k"], how)) == rows(left.join(right, "k", how))
        assert rows(skew.join_unique(left.limit(0), right, ["k"], how)) == []


def test_numbered(spark, rows):
    data = [(k, (7 * n) % 60) for n in range(60) for k in ("hot", "hot2", None)] + [("one", 5), ("one", None)]
    df = spark.createDataFrame(data, "k string, v int").repartition(5)
    got = rows(skew.numbered(df, ["k"], ["v"]))
    assert got == sorted([(k, n, n + 1, 60) for n in range(60) for k in ("hot", "hot2", None)] + [("one", None, 1, 2), ("one", 5, 2, 2)], key=repr)
    assert rows(skew.upper_medians(df, ["k"], "v", "m")) == sorted([("hot", 30), ("hot2", 30), (None, 30), ("one", 5)], key=repr)
    assert rows(skew.numbered(df.limit(0), ["k"], ["v"])) == []


def test_summaries(spark, rows):
    results = spark.createDataFrame([("stored", 2), ("stored", 3), ("skipped", 0), ("failed", 3)], "status string, requests int")
    assert rows(summaries.run_summary(results)) == [(4, 3, 2, 1, 1, 8)]
    probes = spark.createDataFrame([("s", "a", 0, v, "00") for v in (10, 20, 30, 40)] + [("t", "b", 2, 7, "99"), ("t", "b", None, None, None)], "service string, operation string, total_count long, elapsed_ms int, result_code string")
    assert rows(summaries.service_summary(probes)) == [("s", 4, 0, 4, 30), ("t", 2, 1, 0, 7)]
    assert rows(summaries.validation_summary(probes), "services", "passed_ratio", "zero_ratio", "all_passed") == [(2, "4/6", "4/6", False)]


def test_school_lists(spark, rows):
    items = spark.createDataFrame([("2025", "2025", "2"), ("2025", "2025", "1"), ("2024", "2023", "1"), ("2023", "2023", None), ("2022", "2022", "1"), ("2022", "2022", "1"), ("2021", "2021", "1")], "svyYr string, item_year string, schlId string")
    counts = spark.createDataFrame([("2025", 2), ("2024", 1), ("2023", 1), ("2022", 2), ("2021", 5), ("2020", 3)], "svyYr string, expected int")
    assert rows(profiles.school_lists(items, counts), "svyYr", "problem") == [("2020", "no items"), ("2021", "unexpected count"), ("2022", "repeated school"), ("2023", "item without school"), ("2024", "other year"), ("2025", None)]


def column(spark, values, expression):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    return [r[0] for r in df.orderBy("n").select(expression(F.col("v"))).collect()]


def test_names(spark):
    assert column(spark, ["a/b:c*?.xml", " . ", None, "x\x01\x02y", ".name."], text.clean_component) == ["a_b_c_.xml", "unnamed", "unnamed", "x_y", "name"]
    long = "가" * 200 + ".xlsx"
    got = column(spark, [long, "b" * 300, "가" * 79 + " . 나.zip"], text.clean_component)
    assert got[0] == "가" * 78 + ".xlsx" and got[1] == "b" * 240 and got[2] == "가" * 78 + ".zip"
    assert all(len(g.encode()) <= 240 for g in got)
    headers = ["attachment; filename*=utf-8''%EA%B0%80%20b.zip", 'attachment; filename="a%20b.zip"; x', "attachment; filename=" + "가.zip".encode().decode("latin-1"), 'inline; filename="café.zip"', "inline", None, "attachment; filename=100%.zip", "attachment; filename*=UTF-8''a+b.zip"]
    assert column(spark, headers, text.disposition_name) == ["가 b.zip", "a b.zip", "가.zip", "café.zip", "unnamed", "unnamed", "100%.zip", "a+b.zip"]
    assert column(spark, ["  a \n b :: ", "x:", None], text.normalize_label) == ["a b", "x", None]
    assert column(spark, ["2025 x", "24년 y", "1999", "x", None], text.year_of_name) == [2025, 2024, None, None, None]
    assert column(spark, ["fn('a', 'b','','d')", "fn('a')", None], lambda c: text.call_arguments(c, "fn")) == [["a", "b", "", "d"], None, None]
    assert column(spark, ["https://a.b/c", "http://u:p@a/", "https://a/?x", "ftp://a", "https://a/#x", "", None], text.url_problem) == [None, "user information", "query", "not http", "fragment", "empty", "empty"]
    assert column(spark, ["\n <!DOCTYPE HTML>", "<HTML x", "x<html", None], text.looks_like_html) == [True, True, False, False]
    assert column(spark, ["{urn:x}item", "item"], text.local_tag) == ["item", "item"]


def test_safe_params(spark):
    df = spark.createDataFrame([({"serviceKey": "x", "Service-Key": "y", "svyYr": "1"},), (None,)], "p map<string,string>")
    assert [r[0] for r in df.select(text.safe_params(F.col("p"))).collect()] == [{"svyYr": "1"}, None]


def test_unknown_with_repeats(spark, rows):
    asked = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), (None,)], "k string").withColumn("extra", F.lit(1))
    there = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    assert rows(reconcile.unknown(asked, there, "k")) == sorted([("c",), (None,)], key=repr)
    assert rows(reconcile.unknown(asked, there.limit(0), "k")) == sorted([("a",), ("b",), ("c",), (None,)], key=repr)
    assert reconcile.unknown(asked, asked, "k").count() == 0


def test_secrets_in_a_catalogue(spark, rows):
    catalog = catalogue(spark, ("S", "a", "lookup_once", {"api-key": "x", "page": "1"}), ("S", "b", "lookup_once", {"Authorization": "x"}), ("S", "c", "lookup_once", None))
    assert rows(planning.parameter_clashes(catalog)) == [("S", "a", ["api-key"]), ("S", "b", ["Authorization"])]


def test_medians_of_many_values(spark, rows):
    import random

    r = random.Random(6)
    data = [("hot", r.choice([r.random(), 0.5])) for _ in range(30_001)] + [("even", float(n)) for n in range(4)] + [("two", 1.0), ("two", 2.0), ("same", 7.0), ("same", 7.0), ("none", None)]
    got = dict(rows(skew.upper_medians(spark.createDataFrame(data, "k string, v double"), ["k"], "v", "m")))
    values = {}
    for k, v in data:
        values.setdefault(k, []).append(v)
    assert got == {k: sorted(v)[len(v) // 2] for k, v in values.items() if None not in v}


def test_grid_without_a_broadcast(spark, rows):
    endpoints = catalogue(spark, *(("S", s, s, {"page": "1"}) for s in planning.STRATEGIES), ("S", "odd", "no such strategy", None))
    of = dimensions(spark, ["2025", "2024"], [("2025", "1"), ("2024", "2"), ("2024", "2"), ("2023", "3")], ["01", "02"])
    whole = rows(planning.expand(endpoints, *of).select("task_id", "operation"))
    assert len(whole) == 2 + 2 + 2 + 1 + 1 + 2 and len({t for t, _ in whole}) == len(whole)
    spread = planning.expand(endpoints, *of, small_rows=0)
    assert rows(spread.select("task_id", "operation")) == whole
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_probe_rules(spark, rows):
    probes = spark.createDataFrame([(None, "00", 2, 1), ("timeout", None, None, None)], "error string, result_code string, total_count long, item_count long")
    year = spark.createDataFrame([("00", 0), ("00", 3)], "result_code string, total_count long")
    forms = spark.createDataFrame([(5, 0, 0, 0, ["1"], "1", True), (5, 0, 1, 0, ["1", "2"], "1", None)], "single long, omitted long, comma long, pipe long, repeated_schools array<string>, school string, repeated_same boolean")
    pages = spark.createDataFrame([("00", 900, 500), ("00", 901, 400)], "result_code string, total_count long, item_count long")
    got = {r: (n, bad) for r, n, bad in rows(contracts.probe_rules(probes, year, forms, pages, 2, 500))}
    assert got == {
        "answered": (2, 1), "normal": (2, 1), "counted": (2, 1), "all_operations": (1, 0), "year_omitted": (2, 1), "school_omitted": (2, 0),
        "one_parameter_for_several": (2, 1), "repeated_parameter": (2, 1), "page_normal": (2, 0), "page_full": (2, 1), "page_totals": (1, 1),
    }


def test_row_limit_stops(spark):
    with pytest.raises(Exception, match=ERROR):
        contracts.within_limit(spark.createDataFrame([(5,), (7,)], "n int"), "n", 6).collect()
