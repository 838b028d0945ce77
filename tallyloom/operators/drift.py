"""Schemas that drift between files and years: one consistent table and a report of each change.

Tagged-union inference: the parallel schemas of a dataset are fused into one, in which each field
keeps every kind of value that was seen for it, by period. A field whose kind differs between
periods gets a typed branch for each kind beside a canonical text, and the report lists fields that
appear, vanish, are renamed or change kind.

A *dataset* is any set of key columns (``keys``), a *period* an integer. Facts about fields come
from listings of names, facts about values from the payloads; both are combined before a shuffle,
and what is compared afterwards is bounded by datasets, periods and fields, not by rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from datetime import date
from functools import lru_cache
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.nested import NEST, joined, local_name, pivot, triples
from tallyloom.operators.skew import small

#: How alike the contents of two fields must be for a renaming, and their names where there are no contents.
LIKE_CONTENT = 0.5
LIKE_NAME = 0.7
#: Pairs of letters in texts are counted in so many classes, so a field's profile has a fixed size.
TEXT_CLASSES = 1024
_INTEGER = re.compile(r"[+-]?[0-9]+")
_DECIMAL = re.compile(r"[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[+-]?[0-9]+[eE][+-]?[0-9]+")
_DATE = re.compile(r"[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])")
MARKS = "array<struct<field:string,mark:string,weight:double>>"


def plain_name(name: Column) -> Column:
    """A field name without namespace, prefix and outer white space, in its own letter case."""
    text = F.regexp_replace(name, r"^\s+|\s+$", "")
    return F.regexp_replace(F.regexp_replace(text, r"^\{[^}]*\}|^[^:]*:", ""), r"^\s+|\s+$", "")


def kind_of(value: str) -> str | None:
    """integer, decimal, date or text; None for the missing values: empty and ``-``."""
    if value in ("", "-"):
        return None
    if _INTEGER.fullmatch(value):
        return "integer"
    if _DECIMAL.fullmatch(value):
        return "decimal"
    return "date" if _DATE.fullmatch(value) else "text"


def magnitude(value: str) -> float:
    """The binary logarithm of one more than a number's size, also where the number is beyond any float."""
    size = abs(float(value))
    if size < math.inf:
        return math.log2(1 + size)
    mantissa, _, exponent = value.lower().partition("e")
    digits = mantissa.lstrip("+-").partition(".")[0].lstrip("0")
    return (len(digits) + min(float(exponent or 0), 1e100)) * math.log2(10) + math.log2(float(f"0.{digits}"))


def marks_of(values: set[str]) -> dict[str, float]:
    """What a set of values adds to the profile of its field: kinds, moments of magnitudes and of dates in years, letter pairs."""
    out: dict[str, float] = defaultdict(float)
    for value in values:
        kind = kind_of(value)
        if kind is None:
            continue
        out[f"kind {kind}"] += 1
        if kind in ("integer", "decimal"):
            size = magnitude(value)
            for power in range(3):
                out[f"{kind} {power}"] += size**power
        elif kind == "date":
            try:
                years = date.fromisoformat(value).toordinal() / 365.2425
            except ValueError:  # a day that is in no calendar
                continue
            for power in range(3):
                out[f"date {power}"] += years**power
        elif kind == "text":
            framed = f"\x02{value}\x03"
            for pair in map("".join, zip(framed, framed[1:], strict=False)):
                out[f"pair {crc32(pair.encode('utf-8', 'surrogatepass')) % TEXT_CLASSES}"] += 1
    return out


@lru_cache(100_000)
def _field(table: str, path: str) -> tuple[bool, str]:
    """Whether a leaf lies inside an entry's list, object or deeper level, and its field: the whole path as it is there, else the plain name in lower case."""
    whole = joined(table, path)
    return ("/" in whole, whole if "/" in whole else local_name(whole).lower())


def inside_marks(values: dict[str, set[str]]) -> Iterator[tuple[str, str, float]]:
    """The marks of leaves inside an entry by their whole path: each spelling of the path, and the kinds of their values."""
    fields: dict[str, set[str]] = defaultdict(set)
    for path, found in values.items():
        field = path.lower()
        fields[field].update(found)
        yield field, f"as {path}", 1.0
    for field, found in fields.items():
        counts: dict[str, float] = defaultdict(float)
        for kind in filter(None, map(kind_of, found)):
            counts[f"kind {kind}"] += 1
        for mark, weight in counts.items():
            yield field, mark, weight


def payload_marks(df: DataFrame, key: Column, payload: str, spell: Callable[[Column], Column] = lambda key: key) -> DataFrame:
    """One row per well-formed payload: ``file_key`` and the marks of the fields of its entries.

    Equal values of a field in one payload count once. A leaf inside an entry (of a list, an object
    or a deeper level) is a field by its whole path; of it only the kinds count, and its spelling
    (``as``). Payloads that are not well-formed are passed over, as null keys are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ends, marks = [], [0], ([], [], [])
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values: dict[str, set[str]] = defaultdict(set)
                inside: dict[str, set[str]] = defaultdict(set)
                for (table, _), row in pivot(triples(text) or []).items():
                    for path, found in row.items():
                        deep, field = _field(table, path)
                        (inside if deep else values)[field].update(found)
                if values or inside:
                    for field, found in values.items():
                        own = marks_of(found)
                        marks[0].extend([field] * len(own))
                        marks[1].extend(own.keys())
                        marks[2].extend(own.values())
                    for field, mark, weight in inside_marks(inside):
                        marks[0].append(field)
                        marks[1].append(mark)
                        marks[2].append(weight)
                    keys.append(name)
                    ends.append(len(marks[0]))
            flat = pa.StructArray.from_arrays([pa.array(marks[0], pa.string()), pa.array(marks[1], pa.string()), pa.array(marks[2], pa.float64())], ["field", "mark", "weight"])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], ["file_key", "marks"])

    return df.filter(key.isNotNull()).select(spell(key).alias("file_key"), payload).mapInArrow(run, f"file_key string, marks {MARKS}")


def field_facts(listings: DataFrame, keys: list[str], names: str) -> DataFrame:
    """``keys``, ``period``, ``field`` (lower case), ``spelling``, ``listings``: how often each spelling of a field was listed.

    Rows with a null period, a null or an empty list take no part; null and blank names are no fields.
    """
    spelled = listings.filter(f"period is not null and size({names}) > 0").select(*keys, "period", F.explode(F.array_distinct(names)).alias("name"))
    plain = spelled.select(*keys, "period", plain_name(F.col("name")).alias("spelling")).filter("spelling <> ''")
    return plain.groupBy(*keys, "period", F.lower("spelling").alias("field"), "spelling").agg(F.count("*").alias("listings"))


def usual_spellings(facts: DataFrame) -> DataFrame:
    """The most listed spelling of each field over all datasets; ties to the smaller text."""
    counted = facts.groupBy("field", "spelling").agg(F.sum("listings").alias("n"))
    return counted.groupBy("field").agg(F.min_by("spelling", F.struct(-F.col("n"), "spelling")).alias("usual"))


def _after_root(path: str) -> Column:
    return F.expr(f"substr({path}, length(substring_index({path}, '/', 1)) + 1)")


def usual_paths(facts: DataFrame, values: DataFrame) -> DataFrame:
    """``usual_spellings``, and those of the leaves inside entries, which begin with the usual spelling of the listed field."""
    usual = usual_spellings(facts)
    spelled = values.filter("mark like 'as %'").groupBy("field", F.expr("substr(mark, 4)").alias("path")).agg(F.sum("weight").alias("n"))
    inside = spelled.groupBy("field").agg(F.min_by("path", F.struct(-F.col("n"), "path")).alias("path")).join(usual, "field", "left_anti")
    root = usual.select(F.col("field").alias("root"), F.col("usual").alias("first"))
    named = inside.withColumn("root", F.substring_index("field", "/", 1)).join(root, "root", "left")
    return usual.unionByName(named.select("field", F.concat(F.coalesce("first", F.substring_index("path", "/", 1)), _after_root("path")).alias("usual")))


def value_facts(marked: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``period``, ``field``, ``mark``, ``weight``: the fused profiles of the fields by period.

    ``files`` says which dataset and period a ``file_key`` belongs to; repeats there count once.
    """
    known = files.select("file_key", F.struct(*keys, "period").alias("dataset")).filter("file_key is not null and dataset.period is not null")
    of = known.groupBy("file_key").agg(F.collect_set("dataset").alias("datasets"))  # partitioned as the join needs it
    each = marked.join(of, "file_key").select(F.explode("datasets").alias("dataset"), "marks").select("dataset.*", F.inline("marks"))
    return each.groupBy(*keys, "period", "field", "mark").agg(F.sum("weight").alias("weight"))


def fused_schema(facts: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """The fused schema: each field of each period with the alternatives of its kind.

    ``alternatives`` are the kinds seen, sorted; ``kind`` is the one kind of all values, decimal for
    integers among decimals, and null for no values or for other mixtures. Leaves inside entries are
    fields by their whole path where payloads have them; ``listings`` is 0 for them.
    """
    inside = values.filter("field like '%/%'").select(*keys, "period", "field", F.lit(0).cast("long").alias("listings"))
    seen = facts.select(*keys, "period", "field", "listings").unionByName(inside).groupBy(*keys, "period", "field").agg(F.sum("listings").alias("listings"))
    kinds = values.filter("mark like 'kind %'").groupBy(*keys, "period", "field").agg(F.array_sort(F.collect_set(F.substring("mark", 6, 20))).alias("alternatives"))
    one = (
        F.when(F.size("alternatives") == 1, F.col("alternatives")[0])
        .when(F.col("alternatives") == F.array(F.lit("decimal"), F.lit("integer")), "decimal")
    )
    return seen.join(kinds, [*keys, "period", "field"], "left").withColumn("kind", one)


def _distance(a: str, b: str) -> int:
    """How many letters must be changed, added or taken away to turn one name into the other."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


class Content:
    """What the values of a field are like over some periods: the kind at the period ``nearest``, sums for the rest."""

    def __init__(self, marks: dict[int, dict[str, float]], periods: Iterable[int], nearest: int) -> None:
        self.kind: str | None = None
        self.sums: dict[str, float] = defaultdict(float)
        best = None
        for at in periods:
            for mark, weight in marks.get(at, {}).items():
                if mark.startswith("kind "):
                    best = max(filter(None, (best, (-abs(at - nearest), weight, mark[5:]))))
                self.sums[mark] += weight
                if mark.startswith("date "):
                    self.sums[f"{mark} at 1"] += weight * at
                    self.sums[f"{mark} at 2"] += weight * at * at
        if best:
            self.kind = best[2]

    def moments(self) -> list[tuple[float, float]]:
        """Mean and variance of the magnitudes of numbers; of dates in years, and of their distance from the periods."""
        s, k = self.sums, self.kind
        n = s.get(f"{k} 0", 0.0)
        if not n:
            return []
        out = [(s[f"{k} 1"], s[f"{k} 2"])]
        if k == "date":
            out.append((s["date 1"] - s["date 0 at 1"], s["date 2"] - 2 * s["date 1 at 1"] + s["date 0 at 2"]))
        return [(a / n, max(b / n - (a / n) ** 2, 0.0)) for a, b in out]


def likeness(a: Content, b: Content) -> float | None:
    """How alike two contents are, from 0 to 1; -1 for different kinds, None where there is nothing to compare.

    Numbers are compared by their magnitudes, texts by their letter pairs. Dates are alike if they are
    near each other in years, or if they go along with the periods, taken as years.
    """
    if a.kind is None or b.kind is None:
        return None
    if a.kind != b.kind:
        return -1.0
    if a.kind == "text":
        pairs = [{m: w for m, w in c.sums.items() if m.startswith("pair ")} for c in (a, b)]
        norm = math.prod(math.sqrt(sum(w * w for w in p.values())) for p in pairs)
        return sum(w * pairs[1].get(m, 0.0) for m, w in pairs[0].items()) / norm if norm else None
    near = [math.exp(-((m - n) ** 2) / (4 * ((u + v) / 2 + 0.02))) for (m, u), (n, v) in zip(a.moments(), b.moments(), strict=True)] if a.moments() and b.moments() else []
    return max(near, default=None)


def matched(scores: dict[tuple[str, str], float]) -> list[tuple[str, str]]:
    """Pairs of old and new names, each name once, with the largest sum of scores; ties go to the names that sort first.

    Each new pair is reached over the best chain of exchanges from the pairs so far (augmenting paths), so
    no exchange of partners can raise the sum in the end.
    """
    olds, news = sorted({a for a, _ in scores}), sorted({b for _, b in scores})
    partner: dict[str, str] = {}  # by new name
    while True:
        gain = {a: (0.0, [a]) for a in olds if a not in partner.values()}
        best: tuple[float, list[str]] | None = None
        for _ in range(len(olds)):
            reached: dict[str, tuple[float, list[str]]] = {}
            for a, (g, way) in gain.items():
                for b in news:
                    if (a, b) in scores and partner.get(b) != a:
                        total = g + scores[a, b]
                        if b not in partner:
                            if best is None or total > best[0] + 1e-12:
                                best = (total, [*way, b])
                        elif partner[b] not in way:
                            total -= scores[partner[b], b]
                            if total > max(reached.get(partner[b], (-math.inf,))[0], gain.get(partner[b], (-math.inf,))[0]) + 1e-12:
                                reached[partner[b]] = (total, [*way, b, partner[b]])
            if not reached:
                break
            gain |= reached
        if best is None or best[0] <= 0:
            return sorted((a, b) for b, a in partner.items())
        partner |= {b: a for a, b in zip(best[1][::2], best[1][1::2], strict=True)}


def renamed_fields(gone: set[str], come: set[str], marks: dict[str, dict[int, dict[str, float]]], previous: int, period: int) -> dict[str, str]:
    """The fields of ``gone`` whose content goes on under a name of ``come``.

    Contents are those of all periods up to ``previous`` and from ``period`` on, if they are of one kind
    at the change; where either has no values, the names decide. The pairs with the largest sum of
    likenesses beyond the least are taken, each field once, so that two poor pairs do not outweigh a good
    one. The fields of a dataset bound the pairs.
    """
    sides = []
    for fields, here in ((gone, lambda at: at <= previous), (come, lambda at: at >= period)):
        nearest = previous if fields is gone else period
        sides.append({f: Content(marks.get(f, {}), filter(here, marks.get(f, {})), nearest) for f in fields})
    scores = {}
    for old, a in sides[0].items():
        for new, b in sides[1].items():
            names = 1 - _distance(old, new) / max(len(old), len(new))
            content = likeness(a, b)
            if (names >= LIKE_NAME) if content is None else (content >= LIKE_CONTENT):
                scores[old, new] = (0.0 if content is None else content - LIKE_CONTENT) + names / 4 + 1e-9
    return dict(matched(scores))


def kind_of_all(kinds: Iterable[str]) -> str | None:
    """The one kind of all values: decimal for integers among decimals; None for no values and other mixtures."""
    found = set(kinds)
    return "decimal" if found == {"decimal", "integer"} else found.pop() if len(found) == 1 else None


def dataset_changes(facts: Iterable[tuple[int, str, str, float]]) -> list[tuple[int, str, str, str]]:
    """The changes of one dataset: period, kind of change, field, new field (empty but for ``renamed``).

    ``facts`` has period, field, mark and weight; the mark ``listed`` says that the field was listed.
    """
    marks: dict[str, dict[int, dict[str, float]]] = defaultdict(lambda: defaultdict(dict))
    listed: dict[int, set[str]] = defaultdict(set)
    for period, field, mark, weight in facts:
        if mark == "listed":
            listed[period].add(field)
        else:
            marks[field][period][mark] = weight
    periods = sorted(listed)
    out: list[tuple[int, str, str, str]] = []
    for previous, period in zip(periods, periods[1:], strict=False):
        gone, come = listed[previous] - listed[period], listed[period] - listed[previous]
        renamed = renamed_fields(gone, come, marks, previous, period)
        out += [(period, "renamed", old, new) for old, new in renamed.items()]
        out += [(period, "removed", f, "") for f in gone - set(renamed)] + [(period, "added", f, "") for f in come - set(renamed.values())]
    for field, by_period in marks.items():
        root = field if any(field in names for names in listed.values()) else field.partition("/")[0]
        was = None
        for period in periods:
            if root not in listed[period]:
                was = None
            elif kind := kind_of_all(m[5:] for m in by_period.get(period, ()) if m.startswith("kind ")):
                if was and was != kind:
                    out.append((period, "retyped", field, ""))
                was = kind
    return sorted(out)


def schema_changes(facts: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``period``, ``change_kind``, ``field_name``, ``new_name``: each change, in the usual spellings.

    Periods without listings are passed over; a dataset with one period has no changes. The period
    of a change is the first with the new state. For a change of kind, periods without values or with
    mixed kinds are passed over, and the field must have been there in between. Leaves inside entries
    are in no listing, so of them only changes of kind are found, while the field around them is listed.
    The facts about a dataset, bounded by its periods, fields and classes of marks, meet in one task.
    """
    of = dict(facts.dtypes)
    listed = facts.select(*keys, "period", "field", F.lit("listed").alias("mark"), F.col("listings").cast("double").alias("weight"))
    marks = values.filter("mark not like 'as %'").select(*keys, "period", "field", "mark", "weight")
    summed = listed.unionByName(marks).groupBy(*keys, "period", "field", "mark").agg(F.sum("weight").alias("weight"))

    def report(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = dataset_changes(pdf[["period", "field", "mark", "weight"]].itertuples(index=False, name=None))
        return pd.DataFrame([(*key, *change) for change in found], columns=[*keys, "period", "change_kind", "field", "new_field"])

    schema = ", ".join(f"`{k}` {of[k]}" for k in [*keys, "period"]) + ", change_kind string, field string, new_field string"
    changes = summed.groupBy(*keys).applyInPandas(report, schema)
    usual = usual_paths(facts, values)
    return (
        changes.join(usual, "field").withColumnRenamed("usual", "field_name")
        .join(usual.select(F.col("field").alias("new_field"), F.col("usual").alias("new_name")), "new_field", "left")
        .select(*keys, "period", "change_kind", "field_name", F.coalesce("new_name", F.lit("")).alias("new_name"))
    )


def appearing_alternatives(schema: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``period``, ``field``, ``alternative``, ``before``: each kind that the values of a field take on in a period and had not in the one before.

    ``schema`` is ``fused_schema``. Periods in which a field has no values are passed over, and its first
    period with values is no change. Unlike a change of kind it is told of mixtures too; integers are
    no alternative to decimals.
    """
    order = Window.partitionBy(*keys, "field").orderBy("period")
    known = schema.filter("size(alternatives) > 0").select(*keys, "period", "field", "alternatives")
    then = known.withColumn("before", F.lag("alternatives").over(order)).filter("before is not null")
    new = F.array_except("alternatives", F.when(F.array_contains("before", "decimal"), F.array_append("before", F.lit("integer"))).otherwise(F.col("before")))
    return then.select(*keys, "period", "field", F.explode(new).alias("alternative"), "before")


def final_names(changes: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``field`` (lower case), ``since``, ``until``, ``final``: the last name of a field, called ``field`` in the periods from ``since`` to before ``until``.

    The renamings of a dataset, bounded by its fields and periods, are followed in the order of their
    periods, at most one a period, from each name on; a name that is given back or used again has
    one row for each time. ``since`` is null for the first.
    """
    step = F.struct(F.col("period").alias("at"), F.lower("field_name").alias("old"), F.lower("new_name").alias("new"), F.col("new_name").alias("name"))
    each = changes.filter("change_kind = 'renamed'").select(*keys, step.alias("step"))
    ways = each.groupBy(*keys).agg(F.array_sort(F.collect_set("step")).alias("steps"))
    start = F.struct(F.col("step.at").alias("at"), F.col("step.new").alias("new"), F.col("step.name").alias("name"))
    on = lambda done, x: F.when((x["old"] == done["new"]) & (x["at"] > done["at"]), F.struct(x["at"].alias("at"), x["new"].alias("new"), x["name"].alias("name"))).otherwise(done)
    last = F.aggregate("steps", start, on)
    once = ways.select(*keys, "steps", F.explode("steps").alias("step")).select(*keys, F.col("step.old").alias("field"), F.col("step.at").alias("until"), last["name"].alias("final"))
    earlier = F.lag("until").over(Window.partitionBy(*keys, "field").orderBy("until"))
    return once.select(*keys, "field", earlier.alias("since"), "until", "final")


def typed_values(items: DataFrame, value: str = "value") -> DataFrame:
    """Adds a branch for each kind beside the canonical text; missing values are null in all of them.

    A number that no branch can hold (beyond 18 digits, or 38 with 10 decimals) stays in the text branch.
    """
    text = F.trim(value)
    known = F.when((text != "") & (text != "-"), text)
    of = lambda kind, cast: F.when(F.col("canonical").rlike(f"^(?:{kind.pattern})$"), F.col("canonical").try_cast(cast))
    typed = items.withColumn("canonical", known).withColumns({"as_integer": of(_INTEGER, "bigint"), "as_decimal": of(_DECIMAL, "decimal(38,10)"), "as_date": of(_DATE, "date")})
    return typed.withColumn("as_text", F.when(F.col("as_integer").isNull() & F.col("as_decimal").isNull() & F.col("as_date").isNull(), F.col("canonical")))


def final_paths(renamed: DataFrame, values: DataFrame, usual: DataFrame, keys: list[str]) -> DataFrame:
    """``renamed``, the ``final_names``, and the leaves inside entries, whose paths begin with the last name of the listed field, in the usual spelling there."""
    inside = values.filter("field like '%/%'").select(*keys, "field").distinct().withColumn("root", F.substring_index("field", "/", 1))
    moved = inside.join(renamed.select(*keys, F.col("field").alias("root"), "since", "until", "final"), [*keys, "root"]).join(usual, "field", "left")
    path = moved.select(*keys, F.col("field").alias("was"), "since", "until", F.concat("final", _after_root("coalesce(usual, field)")).alias("path")).withColumn("field", F.lower("path"))
    return renamed.unionByName(path.join(usual, "field", "left").select(*keys, F.col("was").alias("field"), "since", "until", F.coalesce("usual", "path").alias("final")))


def unified(items: DataFrame, renamed: DataFrame, usual: DataFrame, keys: list[str]) -> DataFrame:
    """One consistent table of ``keys``, ``period``, ``file_key``, the numbers of the entry, ``field``, ``value_no`` and the typed values.

    ``items`` has the ``entries`` of all levels; a field goes by its last name in its usual spelling, a
    leaf inside an entry by its whole path (``usual_paths``, ``final_paths``). The values of a list are
    rows of their own, numbered by ``value_no``. Rows of no known dataset or period stay, their fields
    under the names that they have.
    """
    place = ["period", "file_key", *(f"{entry}_no" for _, entry in NEST)]
    each = items.select(*keys, *place, F.inline("leaves")).withColumn("field", F.lower("path"))
    r = renamed.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("field").alias("_field"), "since", "until", "final")
    same = (F.col("field") == F.col("_field")) & (F.col("period") < F.col("until")) & (F.col("since").isNull() | (F.col("period") >= F.col("since")))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    named = each.join(small(r), same, "left").join(small(usual), "field", "left")
    final = F.coalesce("final", "usual", "path")
    return typed_values(named.select(*keys, *place, final.alias("field"), "value_no", "value")).drop("value")
