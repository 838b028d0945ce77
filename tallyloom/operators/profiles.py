"""Profiles of XML responses: result, totals, fields, exact duplicates, checksums.

Two readings are offered. The *streaming* one takes the first non-empty code, message and total in
document order, counts outermost items and their direct children; an item's identity is the digest
of its children's names and texts in document order. The *tree* one takes the first element of a
name even if it is empty and counts every item, nested ones too.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.ids import row_digest
from tallyloom.operators.nested import elements

#: Elements that hold the result, and the one that holds a row.
KINDS = {
    "resultCode": "code", "returnReasonCode": "code",
    "resultMsg": "message", "resultMessage": "message", "returnAuthMsg": "message", "errMsg": "message",
    "totalCount": "total",
}
ITEM = "item"
PROFILE = "result_code string, result_message string, total_count long, item_count long, field_names array<string>, duplicate_row_count long, first_code string, all_items long, error string"


def profile(text: str) -> dict:
    """Both readings of one document; ``error`` is set and the rest empty if it is not well-formed."""
    said: dict[str, list[str]] = {"code": [], "message": [], "total": []}
    every = 0
    try:
        rows = defaultdict(list)
        for path, at, value in elements(text):
            every += path[-1] == ITEM
            if kind := KINDS.get(path[-1]):
                said[kind].append(value)
            _take(rows, path, at, value)
    except expat.ExpatError as e:
        return {"error": str(e)}
    code, message, total = (next(filter(None, said[kind]), None) for kind in ("code", "message", "total"))
    items = [tuple(pairs) for pairs in rows.values()]
    return {
        "result_code": code, "result_message": message, "total_count": int(total) if re.fullmatch(r"[+-]?\d{1,18}", total or "") else None,
        "item_count": len(items), "field_names": sorted({name for pairs in items for name, _ in pairs}), "duplicate_row_count": len(items) - len(set(items)),
        "first_code": next(iter(said["code"]), None), "all_items": every, "error": None,
    }


def _take(rows: dict[tuple[int, ...], list[tuple[str, str]]], path: tuple[str, ...], at: tuple[int, ...], value: str) -> None:
    """Puts an element to the row of its outermost item, by the item's ordinals: the item opens it, its children are its pairs."""
    if ITEM in path:
        depth = path.index(ITEM) + 1
        if len(path) <= depth + 1:
            pairs = rows[at[:depth]]
            if len(path) > depth:
                pairs.append((path[-1], value))


def xml_profiles(df: DataFrame, row_id: str, payload: str) -> DataFrame:
    """``row_id`` and ``PROFILE`` of each XML payload; others, null ones too, are passed over."""
    kind = dict(df.dtypes)[row_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("result_code", pa.string()), ("result_message", pa.string()), ("total_count", pa.int64()), ("item_count", pa.int64()), ("field_names", pa.list_(pa.string())), ("duplicate_row_count", pa.int64()), ("first_code", pa.string()), ("all_items", pa.int64()), ("error", pa.string())])
        for batch in batches:
            found = pa.RecordBatch.from_pylist([profile(t) for t in batch.column(1).to_pylist()], schema)
            yield pa.RecordBatch.from_arrays([batch.column(0), *found.columns], [row_id, *schema.names])

    xml = df.select(row_id, payload).filter(F.col(payload).rlike(r"^\s*<"))
    return xml.mapInArrow(run, f"`{row_id}` {kind}, {PROFILE}")


def _exact_items(text: str) -> list[list[dict]]:
    """The children of each outermost item as name-value pairs in document order; none if it is not well-formed."""
    rows = defaultdict(list)
    try:
        for path, at, value in elements(text):
            _take(rows, path, at, value)
    except expat.ExpatError:
        return []
    return [[{"name": n, "value": v} for n, v in pairs] for pairs in rows.values()]


def exact_rows(df: DataFrame, row_id: str, payload: str) -> DataFrame:
    """``row_id``, ``item_no``, ``pairs``: the items of XML payloads as they stand, order and absent children kept.

    Payloads that are not well-formed XML give no rows. Everything that follows is native: equality of
    two responses is equality of their arrays, an item's identity is ``ids.row_digest``.
    """
    kind = dict(df.dtypes)[row_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
        for batch in batches:
            found = [_exact_items(t) for t in batch.column(1).to_pylist()]
            at = pa.array([n for n, items in enumerate(found) for _ in items], pa.int64())
            number = pa.array([n for items in found for n in range(1, len(items) + 1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), number, pa.array([i for items in found for i in items], shape)], [row_id, "item_no", "pairs"])

    xml = df.select(row_id, payload).filter(F.col(payload).rlike(r"^\s*<"))
    return xml.mapInArrow(run, f"`{row_id}` {kind}, item_no long, pairs array<struct<name:string,value:string>>")


def exact_duplicates(items: DataFrame, by: str) -> DataFrame:
    """Items of each response, and how many repeat an earlier one exactly."""
    return items.groupBy(by, row_digest(F.col("pairs")).alias("_digest")).agg(F.count("*").alias("_times")).groupBy(by).agg(F.sum("_times").alias("items"), (F.sum("_times") - F.count("*")).alias("duplicate_items"))


def same_responses(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """Responses that both sides have (``by``): whether their items are equal, in order.

    Items meet by their number and are counted as equal or not, so no response is ever held whole.
    """
    a = left.select(by, "item_no", F.col("pairs").alias("l"), F.lit(True).alias("in_l"))
    b = right.select(by, "item_no", F.col("pairs").alias("r"), F.lit(True).alias("in_r"))
    each = a.join(b, [by, "item_no"], "full").withColumn("equal", F.col("in_l").isNotNull() & F.col("in_r").isNotNull() & F.col("l").eqNullSafe(F.col("r")))
    return each.groupBy(by).agg(F.bool_and("equal").alias("same"), F.count("in_l").alias("l"), F.count("in_r").alias("r")).filter("l > 0 and r > 0").select(by, "same")


def file_facts(df: DataFrame, content: str) -> DataFrame:
    """Adds ``bytes`` and ``digest`` of a text or binary column."""
    data = F.col(content).cast("binary")
    return df.withColumn("bytes", F.octet_length(data).cast("long")).withColumn("digest", F.sha2(data, 256))


def duplicate_rows(df: DataFrame, by: list[str], content: str) -> DataFrame:
    """By group: rows, and how many of them repeat an earlier one exactly. Nulls are equal to each other."""
    digest = F.coalesce(F.sha2(F.col(content), 256), F.lit(""))
    once = df.groupBy(*by, digest.alias("_digest")).agg(F.count("*").alias("_times"))
    return once.groupBy(*by).agg(F.sum("_times").alias("rows"), (F.sum("_times") - F.count("*")).alias("duplicate_rows"))


def school_lists(items: DataFrame, counts: DataFrame) -> DataFrame:
    """The schools of each survey year, with ``problem`` if the list breaks a rule.

    ``items`` has ``svyYr`` (as requested), ``item_year`` and ``schlId``, ``counts`` the ``expected``
    number per ``svyYr``. Each item needs one school and the year asked for, none may repeat, and
    the number must be as announced.
    """
    lists = items.groupBy("svyYr").agg(
        F.count("*").alias("rows"), F.count_if(F.coalesce(F.col("schlId"), F.lit("")) == "").alias("blank"), F.count_if(~F.coalesce(F.col("item_year") == F.col("svyYr"), F.lit(False))).alias("other_year"), F.array_sort(F.collect_set("schlId")).alias("schools")
    )
    problem = (
        F.when(F.col("blank") > 0, "item without school").when(F.col("other_year") > 0, "other year").when(F.col("rows") != F.col("expected"), "unexpected count").when(F.col("rows") != F.size("schools"), "repeated school")
    )
    return counts.join(lists, "svyYr", "left").select("svyYr", F.coalesce("rows", F.lit(0)).alias("rows"), "schools", F.coalesce(problem, F.when(F.col("rows").isNull(), "no items")).alias("problem"))
