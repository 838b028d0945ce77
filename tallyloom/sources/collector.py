"""Collecting one planned response: a probe of one row, then all rows, each judged by the contract.

The network part runs in one task per partition of the plan; a failed task is a row, not an error. A
response beyond the row limit is a row too, so that what was collected beside it can be stored first;
``within_limits`` then stops the job.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import safe_params
from tallyloom.model import MANIFEST
from tallyloom.operators.planning import request_params
from tallyloom.operators.profiles import exact_rows, profile, school_lists, xml_profiles
from tallyloom.sinks.store import raw_paths
from tallyloom.sources.http import fetch, request_url

BEYOND = "beyond the row limit: "

COLLECTED = "task_id string, status string, failure string, requests int, total_count long, item_count long, sha256 string, payload string"


class RowLimit(Exception):
    """A response announces more rows than were ever verified."""


def failure_of(response: dict, facts: dict, wanted: int | None, total: int | None, declared: list[str] | None) -> str | None:
    """The first rule that a response breaks, by the same order as ``contracts.response_failure``.

    ``wanted`` is the page size that was asked for, ``total`` what an earlier probe announced.
    """
    if response["http_status"] != 200:
        return "unexpected status"
    if facts.get("error"):
        return "not well-formed"
    if facts["result_code"] != "00":
        return "unexpected result code"
    if facts["total_count"] is None:
        return "no numeric total"
    if total is not None and facts["total_count"] != total:
        return "total changed"
    if facts["item_count"] != (facts["total_count"] if wanted is None else min(wanted, facts["total_count"])):
        return "unexpected number of items"
    if declared is not None and facts["item_count"] == 0 and facts["field_names"]:
        return "fields without items"
    if declared is not None and set(facts["field_names"]) - set(declared):
        return "undeclared fields"
    return None


def collect_one(endpoint: str, params: dict[str, str], declared: list[str] | None = None, *, probe_rows: int = 1, row_limit: int = 70_000, get=fetch, **key) -> dict:
    """The stored response of one task and how it came about. A probe that has all rows is the response."""
    out = {"status": "failed", "failure": None, "requests": 0, "total_count": None, "item_count": None, "sha256": None, "payload": None}
    total = None
    for size in (probe_rows, None):
        rows = size or total
        response = get(request_url(endpoint, params | {"pageNo": "1", "numOfRows": str(rows)}, **key))
        out["requests"] += response["attempts"]
        if response["error"] and response["http_status"] in (None, 200):
            return out | {"failure": response["error"]}
        facts = profile(response["payload"] or "") if response["http_status"] == 200 else {"error": None}
        done = size is None or (facts.get("total_count") is not None and facts["total_count"] <= probe_rows)
        out["failure"] = failure_of(response, facts, rows, total, declared if done else None)
        if out["failure"]:
            return out
        total = facts["total_count"]
        if total > row_limit:
            raise RowLimit(f"{total} rows")
        if done:
            return out | {"status": "stored", "total_count": total, "item_count": facts["item_count"], "sha256": response["sha256"], "payload": response["payload"]}
    raise AssertionError


def collect(tasks: DataFrame, concurrency: int = 2, between: float = 0.0, **options) -> DataFrame:
    """``COLLECTED`` for tasks with ``task_id, endpoint_url, params, output_fields``.

    ``concurrency`` partitions bound the requests in flight; each pauses for ``between`` seconds after a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("task_id", pa.string()), ("status", pa.string()), ("failure", pa.string()), ("requests", pa.int32()), ("total_count", pa.int64()), ("item_count", pa.int64()), ("sha256", pa.string()), ("payload", pa.string())])
        for batch in batches:
            for task_id, url, params, declared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    row = collect_one(url, dict(params or ()), declared, **options)
                except RowLimit as e:
                    row = {"status": "failed", "failure": f"{BEYOND}{e}", "requests": 1}
                yield pa.RecordBatch.from_pylist([{"task_id": task_id} | row], schema)
                time.sleep(between)

    return tasks.select("task_id", "endpoint_url", "params", "output_fields").repartition(concurrency).mapInArrow(run, COLLECTED)


def within_limits(collected: DataFrame) -> DataFrame:
    """What was collected; raises ``RowLimit`` if any response was beyond the limit. Store the rows first (``session.cut`` or a written table)."""
    if beyond := collected.filter(F.startswith("failure", F.lit(BEYOND))).select("task_id", "failure").first():
        raise RowLimit(f"{beyond.task_id}: {beyond.failure}")
    return collected


def manifest_rows(collected: DataFrame, tasks: DataFrame, collected_at: Column) -> DataFrame:
    """The rows of a manifest for the stored responses, with their profile: every field of ``model.MANIFEST``.

    ``raw_path`` is where ``store.raw_path`` puts a response; secrets are not among the parameters.
    """
    stored = collected.filter("status = 'stored'").select("task_id", "payload", "sha256")
    facts = xml_profiles(stored, "task_id", "payload").select("task_id", "result_code", "total_count", F.col("item_count").alias("row_count"), "field_names", "duplicate_row_count")
    known = tasks.join(stored.select("task_id", "sha256", F.octet_length("payload").cast("long").alias("bytes")), "task_id").join(facts, "task_id")
    rows = known.withColumns({
        "raw_path": raw_paths(F.col("service"), F.col("operation"), F.col("task_id")), "collected_at": collected_at, "http_status": F.lit(200),
        "column_count": F.size("field_names"), "params": safe_params(F.col("params")),
    })
    return rows.select(*(part.split()[0] for part in MANIFEST.split(", ")))


def schools(years: list[str], stored: DataFrame, download: Callable[[str], dict] | None = None) -> DataFrame:
    """The schools of each year out of stored lists (``svyYr``, ``payload``), judged by ``profiles.school_lists``.

    A year that is not stored is fetched by ``download`` (as ``fetch`` gives a response), or an error
    without it. A list that breaks a rule is an error.
    """
    spark = stored.sparkSession
    wanted = spark.createDataFrame([(y,) for y in sorted(set(years))], "svyYr string")
    missing = [r.svyYr for r in wanted.join(stored.select("svyYr"), "svyYr", "left_anti").collect()]
    if missing and download is None:
        raise ValueError(f"no stored lists of schools for {missing}, and none may be fetched")
    fetched = [(year, download(year)["payload"]) for year in missing]
    lists = stored.select("svyYr", "payload").join(wanted, "svyYr", "left_semi").unionByName(spark.createDataFrame(fetched, "svyYr string, payload string"))
    value = lambda name: F.get(F.filter("pairs", lambda p: p["name"] == name), F.lit(0))["value"]
    items = exact_rows(lists, "svyYr", "payload").select("svyYr", value("svyYr").alias("item_year"), value("schlId").alias("schlId"))
    counts = xml_profiles(lists, "svyYr", "payload").groupBy("svyYr").agg(F.sum("total_count").alias("expected"))
    judged = school_lists(items, counts)
    if bad := judged.filter("problem is not null").select("svyYr", "problem").collect():
        raise ValueError(f"unusable lists of schools: {[(r.svyYr, r.problem) for r in bad]}")
    return judged.select("svyYr", F.explode("schools").alias("schlId"))


PROBED = "service string, operation string, scope_strategy string, http_status int, result_code string, total_count long, item_count long, sha256 string, attempts int, error string"


def probe(catalogue: DataFrame, year: str, school: str, division: str, concurrency: int = 2, **options) -> DataFrame:
    """``PROBED``: one representative request of one row for each operation, in order; errors are rows."""
    params = request_params(F.col("scope_strategy"), F.lit(year), F.lit(school), F.lit(division), F.col("fixed_params"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("service", pa.string()), ("operation", pa.string()), ("scope_strategy", pa.string()), ("http_status", pa.int32()), ("result_code", pa.string()), ("total_count", pa.int64()), ("item_count", pa.int64()), ("sha256", pa.string()), ("attempts", pa.int32()), ("error", pa.string())])
        for batch in batches:
            for service, operation, strategy, url, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                r = fetch(request_url(url, dict(asked)), **options)
                facts = profile(r["payload"]) if r["payload"] and not r["error"] else {}
                row = {k: facts.get(k) for k in ("result_code", "total_count", "item_count")} | {k: r[k] for k in ("http_status", "sha256", "attempts")}
                yield pa.RecordBatch.from_pylist([row | {"service": service, "operation": operation, "scope_strategy": strategy, "error": r["error"] or facts.get("error")}], schema)

    asked = catalogue.select("service", "operation", "scope_strategy", "endpoint_url", params.alias("params")).repartition(concurrency)
    return asked.mapInArrow(run, PROBED).orderBy("service", "operation")


@dataclass(frozen=True)
class Policy:
    """Limits of a run; values out of range are an error."""

    concurrency: int = 2
    most_concurrency: int = 4
    attempts: int = 3
    pause: float = 0.5
    timeout: float = 180.0
    probe_rows: int = 1
    row_limit: int = 70_000

    @classmethod
    def of(cls, config: dict, **given: Any) -> Policy:
        """The limits of a configuration (``default_concurrency``, ``max_concurrency``, ``probe_page_size``, ``single_page.max_verified_rows``), with those ``given`` in their place."""
        names = {"default_concurrency": "concurrency", "max_concurrency": "most_concurrency", "probe_page_size": "probe_rows"}
        page = config.get("single_page")
        if not isinstance(page, dict) or "max_verified_rows" not in page or set(names) - set(config):
            raise ValueError("the configuration lacks limits")
        bound = {own: int(config[name]) for name, own in names.items()} | {"row_limit": int(page["max_verified_rows"])}
        return cls(**(bound | {k: v for k, v in given.items() if v is not None}))

    def __post_init__(self) -> None:
        if not 1 <= self.concurrency <= self.most_concurrency:
            raise ValueError("concurrency is out of range")
        if min(self.attempts, self.probe_rows, self.row_limit) < 1 or min(self.pause, self.timeout) < 0:
            raise ValueError("limits must be positive")
