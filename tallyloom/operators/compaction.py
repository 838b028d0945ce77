"""Many small files into few well-sized ones, each stored file's content exactly once.

The listing is first reduced to one row per file: rows are grouped by canonical path, the smallest id
stays. The files are hashed into shards; in each shard, longest first, a heap gives each file to the
least loaded of a fixed number of output groups (about ``target_bytes`` each). A shard fills several
groups, so that few bytes are lost at its end, but has a bounded number of files, however tiny they
are, because every file weighs at least what its row takes. Rows that repeat a file are told by the
plan. The contents of a group are then streamed through pyarrow into one parquet file, read back, and
moved into place; what was planned is compared by key with what the published files hold, and the
manifest is written last, so readers see all that was written or none. Files without content are
listed by shard and counted by group.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import cut

SALTS = 16
TARGET_BYTES = 128 << 20
#: A shard fills about so many groups, and has no more than about so many files if they fill a group.
SHARD_GROUPS, SHARD_FILES = 4, 500_000
#: What a file weighs beside its content: its key and id in the output.
FILE_BYTES = 256
ROW_GROUP_BYTES = 8 << 20
PLAN = "file_key string, file_id long, last_id long, size_bytes long, shard int, output_group int"
WRITTEN = "shard int, output_group int, output_path string, files long, content_bytes long, digest string, planned_files long, planned_bytes long, missing_files long, missing_path string"
MANIFEST, INCOMPLETE = "_manifest.json", "_INCOMPLETE"


class Plan(NamedTuple):
    """``files`` has a row of ``PLAN`` for each file; its shard is ``shard_of`` its key among ``shards``."""

    files: DataFrame
    shards: int


def listed(df: DataFrame, row_id: str, key: Column, size: Column, spell: Callable[[Column], Column] = lambda key: key) -> DataFrame:
    """The rows that point to a file: ``file_id``, ``file_key``, ``size_bytes``. Null keys are no files.

    ``spell`` gives a key its one spelling; it must not turn a key into null.
    """
    return df.filter(key.isNotNull()).select(F.col(row_id).alias("file_id"), spell(key).alias("file_key"), size.cast("long").alias("size_bytes"))


def distinct_files(files: DataFrame) -> DataFrame:
    """One row per file: the smallest and the largest id, and the first row's size (the largest size if it is null there; 0 if null everywhere)."""
    first = F.min_by("size_bytes", "file_id")
    size = F.greatest(F.coalesce(first, F.max("size_bytes"), F.lit(0)), F.lit(0))
    return files.groupBy("file_key").agg(F.min("file_id").alias("file_id"), F.max("file_id").alias("last_id"), size.alias("size_bytes"))


def balance(sizes: list[int], groups: int) -> list[int]:
    """The group of each size: longest first, each to the least loaded group; ties to the smaller group."""
    loads = [(0, g) for g in range(groups)]
    chosen = [0] * len(sizes)
    for i in np.argsort(-np.asarray(sizes, np.int64), kind="stable").tolist():
        load, group = loads[0]
        chosen[i] = group
        heapq.heapreplace(loads, (load + sizes[i], group))
    return chosen


def shard_count(files: int, weight: int, target_bytes: int, shard_files: int = SHARD_FILES) -> int:
    """How many shards: enough for the number of files and of groups, but none that fills less than one group."""
    return max(1, min(max(-(-files // shard_files), weight // (SHARD_GROUPS * target_bytes)), weight // target_bytes))


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def schedule(files: DataFrame, target_bytes: int = TARGET_BYTES, shard_files: int = SHARD_FILES) -> Plan:
    """The output group of each distinct file, balanced within its shard.

    The number of shards follows from the files and their bytes, so neither a shard's size nor its
    share of the last group grows with the input. An empty listing gives an empty plan. A file larger
    than the target gets a group of its own load.
    """
    unique = cut(distinct_files(files))
    whole = unique.agg(F.count("*").alias("files"), F.coalesce(F.sum(F.col("size_bytes") + FILE_BYTES), F.lit(0)).alias("weight")).first()
    shards = shard_count(whole["files"], whole["weight"], target_bytes, shard_files)

    def spread(table: pa.Table) -> pa.Table:
        table = table.sort_by([("file_id", "ascending"), ("file_key", "ascending")])
        weights = (table["size_bytes"].to_numpy() + FILE_BYTES).tolist()
        return table.append_column("output_group", pa.array(balance(weights, max(1, -(-sum(weights) // target_bytes))), pa.int32()))

    sharded = unique.select("file_key", F.col("file_id").cast("long").alias("file_id"), F.col("last_id").cast("long").alias("last_id"), "size_bytes", shard_of(F.col("file_key"), shards).alias("shard"))
    return Plan(sharded.groupBy("shard").applyInArrow(spread, PLAN), shards)


def repeats(files: DataFrame, plan: Plan, salts: int = SALTS) -> DataFrame:
    """The rows whose file the plan takes from a row with a smaller id, with that ``first_id`` and the file's output group.

    Only keys listed more than once are joined back, and a key that many rows share is spread over
    ``salts`` tasks. Rows with the same id and key are one.
    """
    often = plan.files.filter("file_id < last_id").select("file_key", F.col("file_id").alias("first_id"), "shard", "output_group")
    spread = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = files.select("file_id", "file_key", F.pmod(F.xxhash64("file_id"), F.lit(salts)).cast("int").alias("salt"))
    return salted.join(spread, ["file_key", "salt"]).filter("file_id > first_id").select("file_id", "file_key", "first_id", "shard", "output_group")


def group_sizes(plan: Plan) -> DataFrame:
    """Files and bytes of each output group."""
    return plan.files.groupBy("shard", "output_group").agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"))


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder given as a path or an address, and the path there."""
    return fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)


class _Part:
    """One output file while it is written: rows are gathered to row groups of some size."""

    SCHEMA = pa.schema([("file_key", pa.string()), ("file_id", pa.int64()), ("content", pa.binary())])

    def __init__(self, system: fs.FileSystem, staging: str) -> None:
        self.system, self.path, self.writer = system, f"{staging}/{uuid.uuid4().hex}.parquet", None
        self.digest, self.rows, self.size, self.waiting, self.held = hashlib.sha256(), 0, 0, [], 0
        self.planned = self.planned_size = 0

    def add(self, key: str, file_id: int, content: bytes) -> None:
        self.waiting.append({"file_key": key, "file_id": file_id, "content": content})
        self.digest.update(content)
        self.rows, self.size, self.held = self.rows + 1, self.size + len(content), self.held + len(content) + FILE_BYTES
        if self.held > ROW_GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            self.writer = self.writer or pq.ParquetWriter(self.path, self.SCHEMA, compression="zstd", filesystem=self.system)
            self.writer.write_batch(pa.RecordBatch.from_pylist(self.waiting, self.SCHEMA))
        self.waiting, self.held = [], 0

    def finish(self, final: str) -> dict:
        """Closes the file, reads it back, compares, and moves it to its place. Nothing is written for no rows."""
        self.flush()
        if self.writer:
            self.writer.close()
            check, again = hashlib.sha256(), 0
            with self.system.open_input_file(self.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(batch_size=256, columns=["content"]):
                    again += len(batch)
                    for x in batch.column(0):
                        check.update(x.as_py())
            if (again, check.digest()) != (self.rows, self.digest.digest()):
                raise OSError(f"{self.path} does not hold what was written")
            self.system.move(self.path, final)
        return {
            "output_path": final if self.writer else None, "files": self.rows, "content_bytes": self.size, "digest": self.digest.hexdigest(),
            "planned_files": self.planned, "planned_bytes": self.planned_size, "missing_files": self.planned - self.rows,
        }


class _Shard:
    """The open output files of one shard, and the list of its files without content."""

    MISSING = pa.schema([("file_key", pa.string()), ("file_id", pa.int64()), ("output_group", pa.int32())])

    def __init__(self, system: fs.FileSystem, root: str, staging: str, number: int) -> None:
        self.system, self.root, self.staging, self.number = system, root, staging, number
        self.parts: dict[int, _Part] = {}
        self.missing: list[dict] = []
        self.writer: pq.ParquetWriter | None = None
        self.path = f"{staging}/{uuid.uuid4().hex}.parquet"

    def take(self, group: int, key: str, file_id: int, size: int, content: bytes | None) -> None:
        """Takes a planned file; one without content goes to the list."""
        part = self.parts.get(group) or self.parts.setdefault(group, _Part(self.system, self.staging))
        part.planned, part.planned_size = part.planned + 1, part.planned_size + size
        if content is not None:
            part.add(key, file_id, content)
            return
        self.missing.append({"file_key": key, "file_id": file_id, "output_group": group})
        if len(self.missing) >= 10_000:
            self.flush()

    def flush(self) -> None:
        if self.missing:
            self.writer = self.writer or pq.ParquetWriter(self.path, self.MISSING, filesystem=self.system)
            self.writer.write_batch(pa.RecordBatch.from_pylist(self.missing, self.MISSING))
        self.missing = []

    def finish(self) -> pa.RecordBatch:
        self.flush()
        final = None
        if self.writer:
            self.writer.close()
            final = f"{self.root}/missing-{self.number:05d}.parquet"
            self.system.move(self.path, final)
        rows = [{"shard": self.number, "output_group": g} | part.finish(f"{self.root}/part-{self.number:05d}-{g:05d}.parquet") for g, part in sorted(self.parts.items())]
        counts = [(name, pa.int64()) for name in ("planned_files", "planned_bytes", "missing_files")]
        shape = pa.schema([("shard", pa.int32()), ("output_group", pa.int32()), ("output_path", pa.string()), ("files", pa.int64()), ("content_bytes", pa.int64()), ("digest", pa.string()), *counts, ("missing_path", pa.string())])
        return pa.RecordBatch.from_pylist([r | {"missing_path": final if r["missing_files"] else None} for r in rows], shape)


def _write(files: Iterable[tuple[int, int, str, int, int, Any]], folder: str, staging: str) -> Iterator[pa.RecordBatch]:
    """Writes planned files, given by shard, to ``folder``; one batch of ``WRITTEN`` for each shard."""
    system, root = file_system(folder)
    system.create_dir(f"{root}/{staging}", recursive=True)
    shard = None
    for number, group, key, file_id, size, content in files:
        if shard is None or shard.number != number:
            if shard is not None:
                yield shard.finish()
            shard = _Shard(system, root, f"{root}/{staging}", number)
        shard.take(group, key, file_id, size, content)
    if shard is not None:
        yield shard.finish()


def compact(plan: Plan, contents: DataFrame, folder: str) -> DataFrame:
    """``WRITTEN``: writes the contents of each output group to one file of ``folder``.

    ``contents`` has ``file_key`` and ``content`` (binary or text). Plan and contents meet in the
    order of their keys in the task of their shard, so contents are shuffled once and streamed by;
    the groups of a shard are written side by side. Planned files without content are listed in
    ``missing_path`` and counted; a group without any content has no file; contents without a plan are
    left out, and of repeated contents of a key one is taken. ``folder`` must be shared by all
    executors. Each task writes to a name of its own, reads the file back to compare rows and digest,
    and moves it to its place; a task that runs again puts the same bytes there.
    """
    staging = f"_staging-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def files() -> Iterator[tuple]:
            planned = content = None
            for batch in batches:
                for n in range(len(batch)):
                    shard, key, file_id, group, size = (batch.column(c)[n].as_py() for c in range(5))
                    if file_id is not None:
                        if planned is not None:
                            yield (*planned, content)
                        planned, content = (shard, group, key, file_id, size), None
                    elif planned is not None and content is None and planned[2] == key:
                        content = batch.column(5)[n].as_py()
            if planned is not None:
                yield (*planned, content)

        yield from _write(files(), folder, staging)

    planned = plan.files.select("shard", "file_key", "file_id", "output_group", "size_bytes", F.lit(None).cast("binary").alias("content"))
    known = contents.filter("file_key is not null and content is not null")
    null = F.lit(None)
    given = known.select(shard_of(F.col("file_key"), plan.shards).alias("shard"), "file_key", null.cast("long").alias("file_id"), null.cast("int").alias("output_group"), null.cast("long").alias("size_bytes"), F.col("content").cast("binary").alias("content"))
    together = planned.unionByName(given).repartition("shard").sortWithinPartitions("shard", "file_key", F.desc_nulls_last("file_id"))
    return together.mapInArrow(write, WRITTEN)


def compact_store(plan: Plan, store: str, folder: str) -> DataFrame:
    """As ``compact``, with the contents streamed by path out of ``store``: only the plan is shuffled.

    A file's key is its path below ``store``; a file that is not there counts as missing.
    """
    staging = f"_staging-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(store)

        def files() -> Iterator[tuple]:
            for batch in batches:
                for row in batch.to_pylist():
                    try:
                        with system.open_input_stream(f"{root}/{row['file_key']}") as f:
                            content = f.read()
                    except FileNotFoundError:
                        content = None
                    yield row["shard"], row["output_group"], row["file_key"], row["file_id"], row["size_bytes"], content

        yield from _write(files(), folder, staging)

    return plan.files.drop("last_id").repartition("shard").sortWithinPartitions("shard", "output_group", "file_key").mapInArrow(write, WRITTEN)


def contents_of(spark: SparkSession, folder: str) -> DataFrame:
    """``file_key``, ``file_id``, ``content`` of all output files of a folder."""
    return spark.read.schema("file_key string, file_id long, content binary").option("pathGlobFilter", "part-*.parquet").parquet(folder)


def missing_of(spark: SparkSession, folder: str) -> DataFrame:
    """``file_key``, ``file_id``, ``output_group`` of the planned files without content."""
    return spark.read.schema("file_key string, file_id long, output_group int").option("pathGlobFilter", "missing-*.parquet").parquet(folder)


def unlike(plan: Plan, folder: str) -> DataFrame:
    """The keys whose times in the output files are not as planned, beside those that are listed as missing: ``file_key``, ``planned``, ``held``."""
    spark = plan.files.sparkSession
    held = contents_of(spark, folder).groupBy("file_key").agg(F.count("*").alias("held"))
    planned = plan.files.select("file_key", F.lit(1).alias("planned")).join(missing_of(spark, folder).select("file_key"), "file_key", "left_anti")
    both = planned.join(held, "file_key", "full")
    return both.select("file_key", F.coalesce("planned", F.lit(0)).alias("planned"), F.coalesce("held", F.lit(0)).alias("held")).filter("planned <> held")


def publish(plan: Plan, written: DataFrame, folder: str) -> DataFrame:
    """Runs the compaction once, compares it with the plan by key, then writes the manifest, the sign that it ended.

    A folder that has a manifest is refused, before and at the end; output files that do not hold what was
    planned, those that others left in the folder too, are an error, and no manifest is written. The manifest has one line per output
    group, with ``complete``, whether it holds all that was planned; the driver writes it line by line.
    Where any is not complete, ``_INCOMPLETE`` is written first, with the planned, written and missing
    files of the whole; ``missing_path`` lists them.
    """
    system, root = file_system(folder)
    final = f"{root}/{MANIFEST}"
    if system.get_file_info(final).type != fs.FileType.NotFound:
        raise FileExistsError(final)
    done = cut(written)
    system.create_dir(root, recursive=True)
    if wrong := unlike(plan, folder).limit(5).collect():
        raise OSError(f"the published files do not hold what was planned: {[r.file_key for r in wrong]}")
    whole = done.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("planned_files", "files", "missing_files"))).first().asDict()
    if whole["missing_files"]:
        with system.open_output_stream(f"{root}/{INCOMPLETE}") as out:
            out.write((json.dumps(whole, sort_keys=True) + "\n").encode())
    part = f"{root}/_manifest-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        for row in done.orderBy("shard", "output_group").toLocalIterator():
            out.write((json.dumps(row.asDict() | {"complete": row.planned_files == row.files}, sort_keys=True) + "\n").encode())
    if isinstance(system, fs.LocalFileSystem):
        os.link(part, final)  # fails if there is one
        system.delete_file(part)
    elif system.get_file_info(final).type == fs.FileType.NotFound:
        system.move(part, final)
    else:
        raise FileExistsError(final)
    for info in system.get_file_info(fs.FileSelector(root)):
        if info.base_name.startswith("_staging-"):
            system.delete_dir(info.path)
    return done
