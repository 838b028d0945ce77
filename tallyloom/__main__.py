"""Command line: ``python -m tallyloom plan|resume|run|query ...``. Exit codes: 0 done, 1 error, 2 done but for failed tasks.

``plan`` prints the tasks, ``resume`` what of them a manifest lacks, ``run`` collects that, stores the
responses below a folder, appends to the manifest, and prints a summary with the failures.
"""

from __future__ import annotations

import argparse
import json
import re
import sys
import tempfile
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import manifest, planning
from tallyloom.session import cut, telling
from tallyloom.sinks import store
from tallyloom.sources import collector, configs, manifests


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser("tallyloom")
    commands = out.add_subparsers(dest="command", required=True)
    for name, what in (("plan", "expand a catalogue into tasks, less those of a manifest"), ("resume", "the tasks that a manifest lacks"), ("run", "collect what a manifest lacks")):
        plan = commands.add_parser(name, help=what)
        plan.add_argument("--catalogue", required=True, help="JSON or YAML with a list of endpoints")
        plan.add_argument("--year", action="append", default=[])
        plan.add_argument("--division", action="append", default=[], choices=["01", "02"])
        plan.add_argument("--school", action="append", default=[], help="YEAR:SCHOOL, a school of seven digits")
        plan.add_argument("--operation", action="append")
        plan.add_argument("--manifest", required=name != "plan", help="JSON lines of what was stored")
        plan.add_argument("--limit", type=int)
        plan.add_argument("--prefix", default="task-")
        if name == "run":
            plan.add_argument("--store", required=True, help="folder below which responses are stored")
            plan.add_argument("--concurrency", type=int, default=2)
            plan.add_argument("--between", type=float, default=0.0, help="seconds between two tasks")
    query = commands.add_parser("query", help="run a registered query over a folder of tables")
    query.add_argument("name")
    query.add_argument("tables")
    query.add_argument("--out", help="folder for parquet; without it rows are printed as JSON lines")
    return out


def run(args: argparse.Namespace, spark: SparkSession) -> int:
    if args.command == "query":
        from tallyloom.plans import collection, problems, readers, star

        known = {n: q for slate in (collection, star, readers, problems) for n, q in slate.QUERIES.items()}
        if args.name not in known:
            raise ValueError(f"unknown query: {args.name}; there are {', '.join(sorted(known))}")
        df = known[args.name](spark, args.tables)
        if args.out:
            df.write.parquet(args.out)
        else:
            for row in df.toJSON().toLocalIterator():
                print(row)
        return 0
    for year in args.year:
        if len(year) != 4 or not year.isdigit():
            raise ValueError(f"not a year: {year}")
    for school in args.school:
        if not re.fullmatch(r"\d{4}:\d{7}", school):
            raise ValueError(f"not YEAR:SCHOOL with a school of seven digits: {school}")
    if args.limit is not None and args.limit < 1:
        raise ValueError("--limit must be at least 1")
    load = configs.load_json if args.catalogue.endswith(".json") else configs.load_yaml
    declared = configs.endpoints(spark, load(args.catalogue))
    catalogue = planning.select_operations(planning.distinct_endpoints(declared), args.operation)
    years = spark.createDataFrame([(y,) for y in args.year], "svyYr string")
    schools = spark.createDataFrame([tuple(s.split(":", 1)) for s in args.school], "svyYr string, schlId string")
    divisions = spark.createDataFrame([(d,) for d in args.division], "schlDivCd string")
    if catalogue.filter("scope_strategy = 'per_school_by_year'").limit(1).count():
        missing = [r.svyYr for r in planning.missing_years(years, schools).collect()]
        if missing or not args.year:
            raise ValueError(f"no schools for the years {missing or '(none given)'}")
    tasks = planning.expand(catalogue, years, schools, divisions, args.prefix)
    planned = tasks
    if args.manifest and Path(args.manifest).exists():
        tasks = manifest.pending(tasks, manifests.strict(spark, args.manifest))
    tasks = planning.in_order(tasks)
    if args.limit:
        tasks = tasks.limit(args.limit)
    if args.command == "run":
        return collect(args, planned, tasks, declared)
    for row in tasks.toLocalIterator():
        print(json.dumps(row.asDict(), ensure_ascii=False, sort_keys=True))
    return 0


def collect(args: argparse.Namespace, planned: DataFrame, tasks: DataFrame, declared: DataFrame) -> int:
    """Collects ``tasks`` and stores them one by one; the summary counts ``planned``, of which the others were skipped."""
    policy = collector.Policy(concurrency=args.concurrency)
    tasks = cut(tasks)
    fields = tasks.join(declared.select("service", "operation", "output_fields").dropDuplicates(["service", "operation"]), ["service", "operation"])
    with telling(tasks.sparkSession, lambda text: print(text, file=sys.stderr)):
        got = cut(collector.collect(fields, policy.concurrency, args.between, probe_rows=policy.probe_rows, row_limit=policy.row_limit))
    rows = collector.manifest_rows(got, tasks, F.lit(datetime.now(UTC).isoformat(timespec="seconds")))
    log = store.Log(args.manifest)
    Path(args.store).mkdir(parents=True, exist_ok=True)
    for row in rows.join(got.select("task_id", "payload"), "task_id").toLocalIterator():
        record = row.asDict() | {"params": dict(row.params)}
        payload = record.pop("payload").encode()
        with tempfile.NamedTemporaryFile(dir=args.store) as f:
            f.write(payload)
            f.flush()
            store.save(f.name, args.store, record["raw_path"], log, record)
    skipped = planned.count() - tasks.count()
    found = {r.status: r["count"] for r in got.groupBy("status").count().collect()}
    failures = [r.asDict() for r in got.filter("status = 'failed'").select("task_id", "failure").orderBy("task_id").toLocalIterator()]
    requests = got.agg(F.coalesce(F.sum("requests"), F.lit(0)).alias("n")).first().n
    print(json.dumps({"planned": planned.count(), "skipped": skipped, "stored": found.get("stored", 0), "failed": found.get("failed", 0), "http_requests": requests, "failures": failures}, ensure_ascii=False, sort_keys=True))
    collector.within_limits(got)
    return 2 if failures else 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return run(args, SparkSession.builder.appName("tallyloom").getOrCreate())
    except (ValueError, OSError, RuntimeError, collector.RowLimit, store.PathConflict, store.TaskConflict, store.IntegrityError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
