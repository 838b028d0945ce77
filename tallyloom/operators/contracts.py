"""Contracts as ordered rules: the first that fails is the reason, violations go to a quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import url_problem


def first_failure(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule whose failure condition holds; a null condition does not fail."""
    out = F.when(rules[0][0], rules[0][1])
    for failed, name in rules[1:]:
        out = out.when(failed, name)
    return out


def response_failure(expected_total: Column | None = None, page_size: Column | None = None) -> Column:
    """Why a response is not accepted: status, result code, total, changed total, number of items, in this order.

    ``expected_total`` is the total that an earlier probe announced, ``page_size`` the rows asked for.
    """
    total = F.col("total_count")
    wanted = F.least(total, page_size) if page_size is not None else total
    return first_failure(
        (~F.col("http_status").eqNullSafe(200), "unexpected status"),
        (~F.col("result_code").eqNullSafe("00"), "unexpected result code"),
        (total.isNull(), "no numeric total"),
        (F.lit(False) if expected_total is None else expected_total.isNotNull() & (total != expected_total), "total changed"),
        (~F.col("item_count").eqNullSafe(wanted), "unexpected number of items"),
    )


def field_failure(actual: Column, declared: Column, items: Column) -> Column:
    """Undeclared fields, or fields of a response without items; null if there is no objection."""
    extra = F.array_sort(F.array_except(actual, declared))
    return first_failure(((items == 0) & (F.size(actual) > 0), "fields without items"), ((items > 0) & (F.size(extra) > 0), "undeclared fields"))


def shape_failure() -> Column:
    """Why the shape of a manifest row is invalid: names sorted, distinct and not blank, counts that fit."""
    names = F.col("field_names")
    return first_failure(
        (names.isNull(), "no field names"),
        (F.exists(names, lambda n: n.isNull() | (F.trim(n) == "")), "blank field name"),
        (F.size(F.array_distinct(names)) != F.size(names), "repeated field name"),
        (names != F.array_sort(names), "unsorted field names"),
        (~F.col("column_count").eqNullSafe(F.size(names)), "column count differs"),
        (F.coalesce((F.col("duplicate_row_count") < 0) | (F.col("duplicate_row_count") > F.col("row_count")), F.lit(True)), "duplicate count out of range"),
    )


def record_failure() -> Column:
    """Why the facts of a manifest row are invalid: address, status, checksum, negative numbers."""
    return first_failure(
        (url_problem(F.col("endpoint_url")).isNotNull(), "endpoint address"),
        (~F.coalesce(F.col("http_status").between(100, 599), F.lit(False)), "status out of range"),
        (~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)), "checksum format"),
        (F.coalesce(F.col("bytes") < 0, F.lit(False)), "negative size"),
        (F.coalesce(F.col("total_count") < 0, F.lit(False)), "negative total"),
    )


def split(df: DataFrame, failure: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with their ``failure``; no row is lost."""
    judged = df.withColumn("failure", failure)
    return judged.filter("failure is null").drop("failure"), judged.filter("failure is not null")


def within_limit(df: DataFrame, count: str, limit: int) -> DataFrame:
    """The rows; one with more than ``limit`` stops the job."""
    return df.withColumn(count, F.when(F.col(count) > limit, F.raise_error(F.concat(F.lit(f"more than {limit} rows: "), F.col(count).cast("string")))).otherwise(F.col(count)))


def catalogue_contract(catalogue: DataFrame, operations: int, services: int) -> DataFrame:
    """One row: the numbers of a catalogue, and the first rule of its fixed contract that it breaks."""
    counted = catalogue.agg(F.count("*").alias("rows"), F.countDistinct("service").alias("services"), F.countDistinct("service", "operation").alias("pairs"))
    failure = first_failure((F.col("pairs") != F.col("rows"), "repeated operation"), (F.col("rows") != operations, "unexpected number of operations"), (F.col("services") != services, "unexpected number of services"))
    return counted.withColumn("failure", failure)


def assertions(df: DataFrame, **rules: Column) -> DataFrame:
    """One row per rule: ``rule``, ``rows`` that were judged, ``failed``. A null condition fails; no rows pass."""
    each = [F.count_if(~F.coalesce(condition, F.lit(False))).alias(name) for name, condition in rules.items()]
    one = df.agg(F.count("*").alias("rows"), *each)
    return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col("rows"), F.col(n).alias("failed")) for n in rules))).alias("x")).select("x.*")


def declared_fields_failure() -> Column:
    """Why the declared ``output_fields`` of an endpoint cannot be used, or null: none, a blank one, one twice."""
    fields = F.col("output_fields")
    return first_failure(
        (fields.isNull() | (F.size(fields) == 0), "no fields"),
        (F.exists(fields, lambda f: f.isNull() | (F.trim(f) == "")), "blank field"),
        (F.size(F.array_distinct(fields)) != F.size(fields), "repeated field"),
    )


def probe_rules(probes: DataFrame, omitted_year: DataFrame, school_forms: DataFrame, pages: DataFrame, expected: int, page_rows: int) -> DataFrame:
    """The rules that a live service must keep, each with the rows judged and failed.

    ``probes``: ``error, result_code, total_count, item_count`` of one row asked of each operation.
    ``omitted_year``: ``result_code, total_count`` without a year. ``school_forms``: the totals of each
    operation for one school (``single``), none (``omitted``), several in one parameter (``comma``,
    ``pipe``), several parameters (``repeated_schools``: the schools in the answer, ``school``: the first
    one asked for, ``repeated_same``: whether its rows are those of the first alone). ``pages``:
    ``result_code, total_count, item_count`` of two pages that follow each other.
    """
    ok = F.col("result_code") == "00"
    same_total = pages.agg((F.countDistinct("total_count") == 1).alias("same")).select("same")
    return (
        assertions(probes, answered=F.col("error").isNull(), normal=ok, counted=(F.col("total_count") >= 0) & (F.col("item_count") <= 1))
        .unionByName(assertions(probes.agg(F.count("*").alias("n")), all_operations=F.col("n") == expected))
        .unionByName(assertions(omitted_year, year_omitted=ok & (F.col("total_count") == 0)))
        .unionByName(assertions(school_forms, school_omitted=F.col("omitted") == 0, one_parameter_for_several=(F.col("comma") == 0) & (F.col("pipe") == 0), repeated_parameter=F.col("repeated_same") & (F.col("repeated_schools") == F.array("school"))))
        .unionByName(assertions(pages, page_normal=ok, page_full=F.col("item_count") == page_rows))
        .unionByName(assertions(same_total, page_totals=F.col("same")))
    )


def exactly_one(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows; a key that occurs more than once stops the job."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("times"), F.any_value(F.struct(*df.columns)).alias("row"))
    checked = F.when(F.col("times") > 1, F.raise_error(F.concat(F.lit("not unique: "), F.concat_ws("/", *keys)))).otherwise(F.col("row"))
    return counted.select(checked.alias("row")).select("row.*")
