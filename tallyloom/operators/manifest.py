"""What was stored before: resuming, verification, conflicts, and the decision how to publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.skew import join_unique


def skipped(tasks: DataFrame, manifest: DataFrame, key: str = "task_id") -> DataFrame:
    """Tasks that the manifest has."""
    return tasks.join(manifest.select(key).filter(F.col(key).isNotNull()), key, "left_semi")


def pending(tasks: DataFrame, manifest: DataFrame, key: str = "task_id") -> DataFrame:
    """Tasks that the manifest lacks; those without a key are always pending."""
    return tasks.join(manifest.select(key).filter(F.col(key).isNotNull()), key, "left_anti")


def with_status(tasks: DataFrame, manifest: DataFrame, key: str = "task_id") -> DataFrame:
    """Each task with ``status``: skipped or pending. The keys of the manifest are made distinct before the join."""
    known = manifest.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("known", F.lit(True))
    return join_unique(tasks, known, [key]).withColumn("status", F.when(F.col("known"), "skipped").otherwise("pending")).drop("known")


def conflicts(manifest: DataFrame, key: str = "task_id", digest: str = "sha256") -> DataFrame:
    """Keys that were recorded with several checksums."""
    return manifest.filter(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(digest).alias("digests")).filter("digests > 1")


def last_wins(manifest: DataFrame, key: str, order: list[str], where: str | None = None) -> DataFrame:
    """The last row of each key among those that ``where`` selects, with all columns.

    Rows are combined before the shuffle, so no task gets all rows of a key. As the state is a whole row,
    the rows are sorted by key on both sides of it; select the columns that are needed before.
    """
    return _one(manifest, key, order, where, F.max_by)


def first_wins(manifest: DataFrame, key: str, order: list[str], where: str | None = None) -> DataFrame:
    """The first row of each key among those that ``where`` selects."""
    return _one(manifest, key, order, where, F.min_by)


def _one(manifest: DataFrame, key: str, order: list[str], where: str | None, pick) -> DataFrame:
    rows = manifest.filter(where) if where else manifest
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(pick(F.struct(*rows.columns), F.struct(*order)).alias("row")).select("row.*")


def verified(manifest: DataFrame, facts: DataFrame, key: str = "file_key", size: str = "bytes", digest: str = "sha256") -> DataFrame:
    """Manifest rows with ``finding``: missing, changed size, changed content or verified.

    ``facts`` has ``key``, ``fact_size``, ``fact_digest``, one row per file. A null size or checksum in the manifest is not compared.
    """
    joined = join_unique(manifest, facts.withColumn("there", F.lit(True)), [key])
    finding = (
        F.when(F.col("there").isNull(), "missing").when(F.col(size) != F.col("fact_size"), "changed size").when(F.col(digest) != F.col("fact_digest"), "changed content").otherwise("verified")
    )
    return joined.withColumn("finding", finding).drop("there")


def publication(recorded: Column, digests: Column, same_record: Column, verifies: Column, present: Column, same_file: Column) -> Column:
    """How a download is to be published, by what manifest and store hold of it.

    ``recorded``: the manifest has the task; ``digests``: its distinct checksums; ``same_record``: the
    new one is among them; ``verifies``: the recorded file is unchanged; ``present``: the destination
    exists; ``same_file``: with the new content.
    """
    return (
        F.when(recorded & (digests > 1), "task conflict")
        .when(recorded & ~verifies, "integrity error")
        .when(recorded & same_record, "skipped")
        .when(recorded, "task conflict")
        .when(present & same_file, "adopted")
        .when(present, "path conflict")
        .otherwise("stored")
    )
