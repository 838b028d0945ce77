from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tallyloom.operators import drift, nested

KEYS = ["service", "operation"]


def xml(rows):
    return "<r><items>" + "".join("<item>" + "".join(f"<{k}>{v}</{k}>" for k, v in r.items()) + "</item>" for r in rows) + "</items></r>"


def setting(spark, responses):
    """responses: (operation, period, listed names, rows of the payload or None)."""
    listed = [("S", op, period, names, f"f{n}") for n, (op, period, names, _) in enumerate(responses)]
    listings = spark.createDataFrame(listed, "service string, operation string, period int, field_names array<string>, file_key string")
    listings = listings.withColumns({"name": F.lit(1), "spelling": F.lit(2), "listings": F.lit(3)})
    payloads = spark.createDataFrame([(f"f{n}", xml(rows)) for n, (_, _, _, rows) in enumerate(responses) if rows is not None] + [(None, "<r/>"), ("cut", "<r><items><item>")], "path string, payload string")
    marked = drift.payload_marks(payloads.withColumns({"file_key": F.lit("x"), "marks": F.lit(1)}), F.col("path"), "payload")
    return drift.field_facts(listings, KEYS, "field_names"), drift.value_facts(marked, listings, KEYS)


def changes(spark, rows, responses):
    facts, values = setting(spark, responses)
    return rows(drift.schema_changes(facts, values, KEYS), "operation", "period", "change_kind", "field_name", "new_name")


def year(period, names, rows=None, op="o"):
    return (op, period, names, rows)


def test_changes(spark, rows):
    got = changes(spark, rows, [
        year(2019, ["schlId", "c:Cnt ", "dgr", "gone"], [{"schlId": "01", "cnt": v, "dgr": d, "gone": "1"} for v, d in (("100", "학사"), ("-", "석사"), ("", "박사"))]),
        year(2021, ["{urn:x}SCHLID", "cnt", "level", "fresh", None, " "], [{"schlId": "02", "cnt": "약 90", "level": "석사", "fresh": "99999999"}, {"schlId": "02", "cnt": "90건", "level": "학사"}]),
        year(2021, ["schlId"], None),
        year(2022, [], [{"x": "1"}]),
        year(2023, None, None),
        (  "o", None, ["never"], None),
        year(2024, ["schlId", "cnt", "level", "fresh"], [{"cnt": "91건", "level": "학사", "fresh": "1.5"}]),
    ])
    assert got == sorted([
        ("o", 2021, "renamed", "dgr", "level"), ("o", 2021, "removed", "gone", ""), ("o", 2021, "added", "fresh", ""), ("o", 2021, "retyped", "cnt", ""), ("o", 2024, "retyped", "fresh", ""),
    ], key=repr)


def test_names_without_values(spark, rows):
    got = changes(spark, rows, [year(1, ["openYn", "abc"]), year(2, ["opnYn", "xyz"])])
    assert got == sorted([("o", 2, "renamed", "openYn", "opnYn"), ("o", 2, "removed", "abc", ""), ("o", 2, "added", "xyz", "")], key=repr)


def test_mixed_kinds_are_passed_over(spark, rows):
    got = changes(spark, rows, [year(1, ["v"], [{"v": "1"}]), year(2, ["v"], [{"v": "2"}, {"v": "x"}]), year(3, ["v"], [{"v": "1.5"}, {"v": "2"}]), year(4, ["v"], [{"v": "2024-01-31"}])])
    assert got == [("o", 3, "retyped", "v", ""), ("o", 4, "retyped", "v", "")]


def test_ties_empty_and_one_period(spark, rows):
    assert changes(spark, rows, [year(1, ["a"]), year(1, ["a"])]) == []
    facts, values = setting(spark, [year(1, ["a"])])
    assert rows(drift.schema_changes(facts.limit(0), values.limit(0), KEYS)) == []
    twins = [{"a": "5", "b": "5"}], [{"c": "5", "d": "5"}]
    got = changes(spark, rows, [year(1, ["a", "b"], twins[0]), year(2, ["c", "d"], twins[1])])
    assert got == [("o", 2, "renamed", "a", "c"), ("o", 2, "renamed", "b", "d")]


def test_kinds():
    kinds = {"": None, "-": None, "12": "integer", "-7": "integer", "007": "integer", "1.5": "decimal", ".5": "decimal", "1e9": "decimal", "2024-02-30": "date", "2024-13-01": "text", "1,234": "text", "９": "text", "5건": "text"}
    assert {v: drift.kind_of(v) for v in kinds} == kinds
    assert drift.marks_of({"9" * 5000})["integer 0"] == 1
    assert len(drift.marks_of({"가나다" * 30_000 + "x"})) < drift.TEXT_CLASSES + 2


def test_fused_schema_and_typed_values(spark, rows):
    facts, values = setting(spark, [year(1, ["v"], [{"v": "1"}, {"v": "x"}]), year(2, ["v"], [{"v": "2"}])])
    assert rows(drift.fused_schema(facts, values, KEYS), "period", "field", "alternatives", "kind") == [(1, "v", ["integer", "text"], None), (2, "v", ["integer"], "integer")]
    df = spark.createDataFrame([(v,) for v in ["1", " 2.50 ", "2024-01-02", "-", "", None, "abc", "9" * 30]], "value string")
    got = rows(drift.typed_values(df), "canonical", "as_integer", "as_decimal", "as_text")
    assert ("2.50", None, Decimal("2.5"), None) in got and ("9" * 30, None, None, "9" * 30) in got and got.count((None,) * 4) == 3


def renamings(spark, *steps):
    return spark.createDataFrame([("S", "o", at, "renamed", old, new) for at, old, new in steps] + [("S", "o", 2, "removed", "X", "")], "service string, operation string, period int, change_kind string, field_name string, new_name string")


def test_final_names(spark, rows):
    report = renamings(spark, *((2000 + n, f"F{n}", f"F{n + 1}") for n in range(8)))
    assert rows(drift.final_names(report, KEYS), "field", "since", "until", "final") == sorted([(f"f{n}", None, 2000 + n, "F8") for n in range(8)], key=repr)
    back = renamings(spark, (2019, "a", "b"), (2021, "b", "a"))
    assert rows(drift.final_names(back, KEYS), "field", "since", "until", "final") == [("a", None, 2019, "a"), ("b", None, 2021, "a")]
    twice = renamings(spark, (2015, "x", "y"), (2020, "x", "z"))
    assert rows(drift.final_names(twice, KEYS), "field", "since", "until", "final") == sorted([("x", None, 2015, "y"), ("x", 2015, 2020, "z")], key=repr)
    swap = renamings(spark, (2015, "x", "y"), (2015, "y", "x"))
    assert rows(drift.final_names(swap, KEYS), "field", "until", "final") == [("x", 2015, "y"), ("y", 2015, "x")]
    assert drift.final_names(report.limit(0), KEYS).count() == 0


def test_matching_is_best():
    from itertools import permutations
    from random import Random

    r = Random(4)
    for _ in range(300):
        olds, news = [f"o{n}" for n in range(r.randint(1, 4))], [f"n{n}" for n in range(r.randint(1, 4))]
        scores = {(a, b): r.choice([0.25, 0.5, 0.75, 1.0, 1.25]) for a in olds for b in news if r.random() < 0.8}
        found = drift.matched(scores)
        assert len({a for a, _ in found}) == len({b for _, b in found}) == len(found) and set(found) <= set(scores)
        padded = news + [None] * len(olds)
        best = max(sum(scores.get(pair, 0.0) for pair in zip(olds, p, strict=False)) for p in set(permutations(padded, len(olds))))
        assert abs(sum(scores[f] for f in found) - best) < 1e-9, (scores, found)


def test_two_renamed_at_once(spark, rows):
    """Taken one after the other, the likest pair first, these would be exchanged."""
    def values(*means):
        return [{("f" if n < 2 else "g") + str(n): str(round(m * k)) for n, m in means} for k in (0.25, 1, 4)]

    got = changes(spark, rows, [year(1, ["f0", "f1"], values((0, 1000), (1, 2000))), year(2, ["g2", "g3"], values((2, 1900), (3, 3600)))])
    assert got == [("o", 2, "renamed", "f0", "g2"), ("o", 2, "renamed", "f1", "g3")]


def test_a_good_pair_beats_two_poor_ones(spark, rows):
    def values(**means):
        return [{k: str(round(m * f)) for k, m in means.items()} for f in (0.25, 1, 4)]

    got = changes(spark, rows, [year(1, ["f0", "f1"], values(f0=1000, f1=6000)), year(2, ["g2", "g3"], values(g2=1000, g3=170))])
    assert got == sorted([("o", 2, "renamed", "f0", "g2"), ("o", 2, "removed", "f1", ""), ("o", 2, "added", "g3", "")], key=repr)


def test_appearing_alternatives(spark, rows):
    facts, values = setting(spark, [year(1, ["v"], [{"v": "1"}]), year(2, ["v"], [{"v": "2"}, {"v": "x"}]), year(3, ["v"], [{"v": "-"}]), year(4, ["v"], [{"v": "1.5"}]), year(5, ["v"], [{"v": "7"}])])
    found = drift.appearing_alternatives(drift.fused_schema(facts, values, KEYS), KEYS)
    assert rows(found, "period", "field", "alternative", "before") == sorted([(2, "v", "text", ["integer"]), (4, "v", "decimal", ["integer", "text"])], key=repr)


def test_magnitudes_of_very_long_numbers():
    long = "1" * 299
    assert abs(drift.magnitude(f"{long}e+55") - 353 * 3.3219) < 2 and abs(drift.magnitude("9" * 5000) - 5000 * 3.3219) < 1
    assert drift.magnitude("-0.000") == 0 and drift.magnitude("1e-5000") == 0 and drift.magnitude("3") == 2 and drift.magnitude("1e" + "9" * 400) > 1e99
    assert drift.marks_of({f"{long}.5e+5", "-1.5"})["decimal 0"] == 2


def test_leaves_inside_entries(spark, rows):
    payload = "<r><items><item><Cd>07</Cd><note><item>1</item><item>x</item></note><majorList><major><nm>화학</nm><quotaList><quota><n>{0}</n></quota></quotaList></major></majorList></item></items></r>"
    names = {1: ["cd", "note", "majorList"], 2: ["cd", "remark", "majorList"]}
    texts = {"f1": payload.format(5), "f2": '{"items": [{"cd": "08", "remark": {"Item": ["2", "y"]}, "majorList": [{"nm": "물리", "quotaList": [{"n": "1.5"}]}]}]}'}
    listings = spark.createDataFrame([("S", "o", n, names[n], f"f{n}") for n in names], "service string, operation string, period int, field_names array<string>, file_key string")
    payloads = spark.createDataFrame([*texts.items()], "path string, payload string")
    facts, values = drift.field_facts(listings, KEYS, "field_names"), drift.value_facts(drift.payload_marks(payloads, F.col("path"), "payload"), listings, KEYS)
    schema = rows(drift.fused_schema(facts, values, KEYS).filter("field like '%/%'"), "period", "field", "alternatives", "kind")
    assert (1, "note/item", ["integer", "text"], None) in schema and (2, "majorlist/major/quotalist/quota/n", ["decimal"], "decimal") in schema and len(schema) == 6
    assert ("o", 2, "retyped", "majorList/major/quotaList/quota/n", "") in rows(drift.schema_changes(facts, values, KEYS), "operation", "period", "change_kind", "field_name", "new_name")
    renamed = spark.createDataFrame([("S", "o", "note", None, 2, "remark")], "service string, operation string, field string, since int, until int, final string")
    usual = drift.usual_paths(facts, values)
    items = nested.entries(payloads.withColumnRenamed("path", "file_key"), "file_key", "payload").join(listings.drop("field_names"), "file_key")
    got = rows(drift.unified(items, drift.final_paths(renamed, values, usual, KEYS), usual, KEYS), "period", "item_no", "major_no", "quota_no", "field", "value_no", "canonical", "as_integer")
    assert got == sorted([
        (1, 1, 0, 0, "cd", 1, "07", 7), (1, 1, 0, 0, "remark/Item", 1, "1", 1), (1, 1, 0, 0, "remark/Item", 2, "x", None),
        (1, 1, 1, 0, "majorList/major/nm", 1, "화학", None), (1, 1, 1, 1, "majorList/major/quotaList/quota/n", 1, "5", 5),
        (2, 1, 0, 0, "cd", 1, "08", 8), (2, 1, 0, 0, "remark/Item", 1, "2", 2), (2, 1, 0, 0, "remark/Item", 2, "y", None),
        (2, 1, 1, 0, "majorList/major/nm", 1, "물리", None), (2, 1, 1, 1, "majorList/major/quotaList/quota/n", 1, "1.5", None),
    ], key=repr)
    alone = items.withColumns({"service": F.lit(None).cast("string"), "operation": F.lit(None).cast("string"), "period": F.lit(None).cast("int")})
    left = drift.unified(alone, drift.final_paths(renamed, values, usual, KEYS), usual, KEYS)
    assert left.count() == len(got) and {r.field for r in left.filter("field like '%tem'").collect()} == {"note/item", "remark/Item"}


def test_dates_are_compared(spark, rows):
    def dated(names, since, *days):
        return [dict(zip(names, (day, f"{since}-0{n}-15"), strict=True)) for n, day in enumerate(days, 1)]

    got = changes(spark, rows, [
        year(2020, ["crtrYmd", "opened"], dated(["crtrYmd", "opened"], 1971, "2020-04-01", "2020-04-02")),
        year(2021, ["crtrYmd", "opened"], dated(["crtrYmd", "opened"], 1971, "2021-04-01", "2021-04-02")),
        year(2024, ["baseDt", "closes"], dated(["baseDt", "closes"], 2090, "2024-04-01", "2024-04-02")),
    ])
    assert got == sorted([("o", 2024, "renamed", "crtrYmd", "baseDt"), ("o", 2024, "removed", "opened", ""), ("o", 2024, "added", "closes", "")], key=repr)
    got = changes(spark, rows, [year(1, ["openDt"], [{"openDt": "2021-02-30"}]), year(2, ["opnDt"], [{"opnDt": "2022-02-30"}])])
    assert got == [("o", 2, "renamed", "openDt", "opnDt")]
