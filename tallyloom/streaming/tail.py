"""The manifest as a stream: new rows as they are appended (an extension of the batch reader).

Rows are made unique by their key against all that was written before, so replays of a file do not
count twice, however late a row comes or in which order a backlog is read. Rows without a readable
time go to a quarantine; counts are by window of event time, so late rows go where they belong.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.model import MANIFEST

KEYS = ("task_id", "sha256")
UNREADABLE = "_corrupt_record"


def tail(spark: SparkSession, folder: str, schema: str = MANIFEST) -> DataFrame:
    """A stream of all manifest rows from the JSON-lines files of a folder, with their ``event_time`` and the text of unreadable lines."""
    read = spark.readStream.schema(f"{schema}, {UNREADABLE} string").option("columnNameOfCorruptRecord", UNREADABLE)
    return read.option("maxFilesPerTrigger", 100).json(folder).withColumn("event_time", F.try_to_timestamp("collected_at"))


def counts(rows: DataFrame, by: list[str], window: str = "1 day") -> DataFrame:
    """Rows and bytes by window of event time and by ``by``."""
    return rows.groupBy(F.window("event_time", window), *by).agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).select(F.col("window.start").alias("since"), *by, "rows", "bytes")


def append_new(rows: DataFrame, target: str, keys: list[str]) -> None:
    """Appends one row for each of ``keys`` that ``target`` does not hold; null keys are equal. The same rows again add nothing."""
    rows.limit(0).write.mode("ignore").parquet(target)
    held = rows.sparkSession.read.schema(rows.schema).parquet(target).select(*keys)
    new = rows.dropDuplicates(keys).alias("n")
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    new.join(held.alias("h"), same, "left_anti").write.mode("append").parquet(target)


def run_once(stream: DataFrame, target: str, checkpoint: str, quarantine: str | None = None) -> None:
    """Processes what is there and stops; a later call goes on from the checkpoint.

    Each (task, checksum) is written to ``target`` once; rows without an event time go to
    ``quarantine`` (``target`` with ``-quarantine`` by default), each distinct row once. A batch that
    runs again after a failure adds what is missing. Each batch reads the keys of the whole target.
    """
    beside = quarantine or f"{target.rstrip('/')}-quarantine"
    context = stream.sparkSession.sparkContext
    log = context._jvm.org.apache.hadoop.fs.Path(target, "_spark_metadata")
    if log.getFileSystem(context._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"{target} has a log of the file sink, so rows appended beside it would not be read")

    def write(batch: DataFrame, _: int) -> None:
        append_new(batch.filter("event_time is not null").drop(UNREADABLE), target, list(KEYS))
        undated = batch.filter("event_time is null").drop("event_time")
        append_new(undated.withColumn("row_digest", F.sha2(F.to_json(F.struct("*")), 256)), beside, ["row_digest"])

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
