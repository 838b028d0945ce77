"""Summaries of runs and probes. Each is one aggregation with partial results before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import ratio
from tallyloom.operators.skew import upper_medians


def run_summary(results: DataFrame) -> DataFrame:
    """One row from ``status`` (stored, skipped, failed) and ``requests`` of each task."""
    status = F.col("status")
    return results.agg(
        F.count("*").alias("planned"), F.count_if(status != "failed").alias("completed"), F.count_if(status == "stored").alias("stored"),
        F.count_if(status == "skipped").alias("skipped"), F.count_if(status == "failed").alias("failed"), F.coalesce(F.sum("requests"), F.lit(0)).alias("http_requests"),
    )


def service_summary(probes: DataFrame) -> DataFrame:
    """By service: probes, those with and without rows, and the upper median of the milliseconds."""
    total = F.col("total_count")
    counts = probes.groupBy("service").agg(F.count("*").alias("operations"), F.count_if(total > 0).alias("with_rows"), F.count_if(total == 0).alias("zero_rows"))
    medians = upper_medians(probes, ["service"], "elapsed_ms", "median_ms").withColumnRenamed("service", "_service")
    return counts.join(medians, counts.service.eqNullSafe(medians._service), "left").drop("_service")


def validation_summary(probes: DataFrame) -> DataFrame:
    """One row: distinct services, operations, those that passed, and ratios as text."""
    passed = F.coalesce(F.col("result_code") == "00", F.lit(False))
    return probes.agg(
        F.countDistinct("service").alias("services"), F.countDistinct("service", "operation").alias("operations"), F.count_if(passed).alias("passed"),
        ratio(passed).alias("passed_ratio"), ratio(F.coalesce(F.col("total_count") == 0, F.lit(False))).alias("zero_ratio"), F.bool_and(passed).alias("all_passed"), F.bool_or(passed).alias("any_passed"),
    )


def outcome_table(probes: DataFrame) -> DataFrame:
    """The table behind a report: a row for each service, a column for each outcome of its operations, and their number."""
    outcome = F.when(F.coalesce(F.col("result_code") != "00", F.lit(True)), "failed").when(F.col("total_count") > 0, "with_rows").otherwise("zero_rows")
    table = probes.withColumn("_outcome", outcome).groupBy("service").pivot("_outcome", ["with_rows", "zero_rows", "failed"]).count().na.fill(0, ["with_rows", "zero_rows", "failed"])
    return table.withColumn("operations", F.col("with_rows") + F.col("zero_rows") + F.col("failed"))
