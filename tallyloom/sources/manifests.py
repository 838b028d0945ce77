"""Append-only JSON-lines manifests, strict and lenient.

Lines are read by the text source, so a growing log is split over many tasks. A line's number comes
from the numbers of lines in the blocks before its own, a table of one row per block; whether the
last line of a file was ended comes from the last byte of the file, which one task per file reads.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.paths import location
from tallyloom.model import MANIFEST, MANIFEST_REQUIRED, PORTAL_MANIFEST
from tallyloom.operators.compaction import file_system

LINES = "path string, line_no long, line string, ended boolean, last boolean"


def _closed(files: DataFrame) -> DataFrame:
    """``path`` and ``closed``: whether a newline is the last byte of the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                system, name = file_system(path)
                with system.open_input_file(name) as f:
                    size = f.size()
                    found.append(size > 0 and f.read_at(1, size - 1) == b"\n")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.bool_())], ["path", "closed"])

    return files.select("path").mapInArrow(run, "path string, closed boolean")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files of ``path`` with their number, whether a newline ends them and whether no other follows.

    Blank lines are counted but left out; the last line is the last that is not blank.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = None, 0
        for batch in batches:
            places = []
            for place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                here, at = place, at + 1 if place == here else 0
                places.append(at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], ["path", "block", "line", "at"])

    read = spark.read.option("lineSep", "\n").text(path)
    found = read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    rows = found.mapInArrow(count, "path string, block long, line string, at long")  # one task reads a block from its start to its end
    full = F.col("line").rlike(r"\S")
    blocks = rows.groupBy("path", "block").agg(F.count("*").alias("n"), F.max(F.when(full, F.col("at"))).alias("last_full"))
    file = Window.partitionBy("path")
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last_block = F.max(F.when(F.col("last_full").isNotNull(), F.col("block"))).over(file)
    placed = blocks.withColumns({"before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "total": F.sum("n").over(file), "last_at": F.when(F.col("block") == last_block, F.col("last_full"))})
    known = placed.join(_closed(blocks.select("path").distinct()), "path").select("path", "block", "before", "total", "last_at", "closed")
    number = F.col("before") + F.col("at") + 1
    return rows.filter(full).join(known, ["path", "block"]).select("path", number.alias("line_no"), "line", ((number < F.col("total")) | F.col("closed")).alias("ended"), F.coalesce(F.col("at") == F.col("last_at"), F.lit(False)).alias("last"))


# Filters may be moved past an error that an expression raises, so its condition repeats theirs.


def _parsed(found: DataFrame, schema: str) -> DataFrame:
    parsed = F.from_json("line", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return found.withColumn("row", parsed).withColumn("bad", F.col("row").isNull() | F.col("row._corrupt_record").isNotNull())


def strict(spark: SparkSession, path: str) -> DataFrame:
    """The rows of API manifests with ``path`` and ``line_no``.

    A line without newline at the end of a file was cut while being written and is left out; any
    other bad line, or one that lacks a required field, stops the job.
    """
    rows = _parsed(lines(spark, path).filter("ended or not last"), MANIFEST)
    lacking = F.lit(False)
    for name in MANIFEST_REQUIRED:
        lacking = lacking | F.col(f"row.{name}").isNull()
    where = F.concat(F.lit("corrupt manifest line "), F.col("line_no").cast("string"), F.lit(" of "), "path")
    checked = F.when((F.col("bad") | lacking) & (F.col("ended") | ~F.col("last")), F.raise_error(where)).otherwise(F.col("row"))
    return rows.select("path", "line_no", checked.alias("row")).select("path", "line_no", "row.*").drop("_corrupt_record")


def lenient(spark: SparkSession, path: str, schema: str = PORTAL_MANIFEST) -> DataFrame:
    """The rows of portal manifests that were downloaded, the last of each task.

    A bad last line is passed over; any other bad line stops the job.
    """
    rows = _parsed(lines(spark, path), schema).filter("not (bad and last)")
    where = F.concat(F.lit("corrupt manifest line "), F.col("line_no").cast("string"), F.lit(" of "), "path")
    good = rows.select("path", "line_no", F.when(F.col("bad") & ~F.col("last"), F.raise_error(where)).otherwise(F.col("row")).alias("row")).select("path", "line_no", "row.*").drop("_corrupt_record")
    done = good.filter("status = 'downloaded' and task_id <> ''")
    names = [c for c in done.columns if c not in ("path", "line_no")]
    return done.groupBy("task_id").agg(F.max_by(F.struct(*(n for n in names if n != "task_id")), F.struct("path", "line_no")).alias("row")).select("task_id", "row.*")


def facts(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``fact_size``, ``fact_digest`` of the files of a store."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("fact_size"), F.sha2("content", 256).alias("fact_digest"))


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """``file_key`` (the path below ``folder``) and ``content`` of all files of a store, for ``compaction.compact``."""
    root = folder.removeprefix("file://").rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(location(F.col("path"), root).alias("file_key"), "content")
