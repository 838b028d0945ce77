from __future__ import annotations

import json
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyloom.sources.manifests import contents
from tallyloom.plans.problems import QUERIES
from tallyloom.operators.compaction import Plan, balance, compact, compact_store, group_sizes, listed, publish, repeats, schedule, shard_count

ROWS = "id long, path string, size long"


def files(spark, data):
    df = spark.createDataFrame(data, ROWS).withColumns({"file_key": F.lit("clash"), "salt": F.lit(0), "first_id": F.lit(0)})
    return listed(df, "id", F.col("path"), F.col("size"))


def test_repeats(spark, rows):
    random.seed(2)
    data = [(n, random.choice(["hot"] * 10 + ["a", "b", "c", None]), 1) for n in range(200)] + [(500 + n, f"one{n}", None) for n in range(20)]
    first, wanted = {}, []
    for n, path, _ in data:
        if path is not None and first.setdefault(path, n) != n:
            wanted.append((n, path, first[path]))
    found = lambda data: rows(repeats(files(spark, data), schedule(files(spark, data))), "file_id", "file_key", "first_id")
    assert found(data) == sorted(wanted, key=repr)
    assert found([]) == []
    assert found([(1, "a", 1), (1, "a", 1), (2, None, 3)]) == []


def test_balance():
    random.seed(3)
    for _ in range(50):
        sizes = [random.randint(0, 100) for _ in range(random.randint(0, 60))]
        groups = random.randint(1, 7)
        chosen = balance(sizes, groups)
        loads = [0] * groups
        for s, g in zip(sizes, chosen, strict=True):
            loads[g] += s
        # longest first is within 4/3 of the best possible, which is at least the mean and the largest
        assert max(loads) <= max(sum(sizes) / groups, max(sizes, default=0)) * 4 / 3 + max(sizes, default=0) / 3


def test_schedule(spark, rows):
    random.seed(4)
    data = [(n, f"p{n % 150}", random.choice([None, random.randint(0, 1000)])) for n in range(200)]
    plan = schedule(files(spark, data), target_bytes=20_000, shard_files=60)
    assert plan.shards == 3 and plan.files.count() == 150 == plan.files.select("file_key").distinct().count()
    assert plan.files.select("shard").distinct().count() == 3
    assert all(r.bytes + 256 * r.files < 24_000 for r in group_sizes(plan).collect())
    assert rows(schedule(files(spark, [])).files) == []


def test_shards_follow_bytes_and_files(spark, rows):
    tiny = [(n, f"p{n}", 100) for n in range(200)]
    assert rows(group_sizes(schedule(files(spark, tiny), target_bytes=1 << 20, shard_files=20)), "files", "bytes") == [(200, 20_000)]
    assert shard_count(50_000, 50_000 * 1024, 128 << 20) == 1 and shard_count(10**9, 10**9 * 2048, 128 << 20) == 10**9 * 2048 // (4 * 128 << 20)
    assert shard_count(10**6, 1 << 50, 128 << 20) == (1 << 50) // (4 * 128 << 20) and shard_count(0, 0, 128 << 20) == 1
    assert shard_count(10**9, 10**9 * 256, 128 << 20) <= 10**9 * 256 // (128 << 20)  # no shard is less than one group


def test_compact(spark, tmp_path):
    random.seed(5)
    contents = {f"p{n}": random.randbytes(random.randint(0, 300)) for n in range(80)}
    data = [(n, f"p{n % 100}", 200) for n in range(130)]
    plan = schedule(files(spark, data), target_bytes=9_000, shard_files=40)
    assert plan.shards == 3
    given = spark.createDataFrame([*contents.items(), ("p1", contents["p1"]), ("unlisted", b"x"), (None, b"y"), ("p99", None)], "file_key string, content binary")
    for folder in (str(tmp_path / "a"), f"file://{tmp_path}/b"):
        written = publish(plan, compact(plan, given, folder), folder).collect()
        root = folder.removeprefix("file://")
        got = {}
        for r in written:
            t = pq.read_table(r.output_path).to_pylist() if r.output_path else []
            assert len(t) == r.files and sum(len(x["content"]) for x in t) == r.content_bytes
            for x in t:
                assert x["file_key"] not in got
                got[x["file_key"]] = x["content"]
        assert got == contents
        lines = open(f"{root}/_manifest.json").read().splitlines()
        assert sorted(json.loads(x)["digest"] for x in lines) == sorted(r.digest for r in written)
        assert not list((tmp_path / root.rsplit("/", 1)[1]).glob("_staging*"))


def test_compact_a_store(spark, tmp_path):
    store = tmp_path / "store"
    wanted = {}
    for n in range(30):
        path = store / f"op{n % 3}" / f"{n}.xml"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(wanted.setdefault(f"op{n % 3}/{n}.xml", f"<r>{n}</r>".encode()))
    found = contents(spark, str(store))
    df = found.select(F.monotonically_increasing_id().alias("id"), F.concat(F.lit("./"), "file_key").alias("path"), F.length("content").alias("size"))
    plan = schedule(listed(df, "id", F.col("path"), F.col("size"), lambda p: F.substring(p, 3, 1000)), target_bytes=100)
    plan = plan._replace(files=spark.createDataFrame(plan.files.collect(), plan.files.schema))
    (store / "op0" / "0.xml").unlink()
    found = contents(spark, str(store))
    for out, written in ((str(tmp_path / "out"), lambda to: compact(plan, found, to)), (str(tmp_path / "by_path"), lambda to: compact_store(plan, str(store), to)), (f"file://{tmp_path}/by_address", lambda to: compact_store(plan, f"file://{store}", to))):
        got, lost = {}, set()
        for r in publish(plan, written(out), out).collect():
            got |= {x["file_key"]: x["content"] for x in pq.read_table(r.output_path).to_pylist()} if r.output_path else {}
            lost |= {x["file_key"] for x in pq.read_table(r.missing_path).to_pylist()} if r.missing_path else set()
        assert got == {k: v for k, v in wanted.items() if k != "op0/0.xml"} and lost == {"op0/0.xml"}


def small_plan(spark):
    return Plan(spark.createDataFrame([("a", 1, 1, 2, 0, 0), ("b", 2, 2, 3, 0, 0), ("c", 3, 3, 4, 0, 1)], "file_key string, file_id long, last_id long, size_bytes long, shard int, output_group int"), 1)


def test_missing_contents_are_reported(spark, tmp_path):
    plan = small_plan(spark)
    given = spark.createDataFrame([("a", b"xy"), ("b", None)], "file_key string, content binary")
    part = tmp_path / "part"
    done = publish(plan, compact(plan, given, str(part)), str(part))
    lines = [json.loads(x) for x in (part / "_manifest.json").read_text().splitlines()]
    assert [(x["output_group"], x["planned_files"], x["planned_bytes"], x["files"], x["missing_files"], x["complete"]) for x in lines] == [(0, 2, 5, 1, 1, False), (1, 1, 4, 0, 1, False)]
    assert json.loads((part / "_INCOMPLETE").read_text()) == {"planned_files": 3, "files": 1, "missing_files": 2}
    assert {r.missing_path for r in done.collect()} == {str(part / "missing-00000.parquet")}
    assert pq.read_table(part / "missing-00000.parquet").to_pylist() == [{"file_key": "b", "file_id": 2, "output_group": 0}, {"file_key": "c", "file_id": 3, "output_group": 1}]
    whole = spark.createDataFrame([(k, b"z") for k in "abc"], "file_key string, content binary")
    publish(plan, compact(plan, whole, str(tmp_path / "whole")), str(tmp_path / "whole"))
    assert not (tmp_path / "whole" / "_INCOMPLETE").exists() and '"complete": false' not in (tmp_path / "whole" / "_manifest.json").read_text()
    with pytest.raises(FileExistsError):
        publish(plan, compact(plan, whole, str(tmp_path / "whole")), str(tmp_path / "whole"))


def test_a_lost_or_doubled_file_is_not_published(spark, tmp_path):
    plan = small_plan(spark)
    whole = spark.createDataFrame([(k, b"z") for k in "abc"], "file_key string, content binary")
    for n, other in enumerate((plan.files.filter("file_key <> 'b'"), plan.files.unionByName(plan.files.withColumn("shard", F.lit(1))))):
        folder = str(tmp_path / f"bad{n}")
        with pytest.raises(OSError, match="do not hold what was planned"):
            publish(plan, compact(Plan(other, 1), whole, folder), folder)
        assert not (tmp_path / f"bad{n}" / "_manifest.json").exists()


def test_queries_have_the_production_target(spark, rows, tmp_path):
    listing = [(n, f"data/{n}.xml", 1 << 20) for n in range(130)]
    spark.createDataFrame(listing, "record_id long, raw_path string, bytes long").write.parquet(str(tmp_path / "manifest_records.parquet"))
    assert rows(QUERIES["p2_groups"](spark, str(tmp_path)), "files", "bytes") == [(65, 65 << 20), (65, 65 << 20)]
