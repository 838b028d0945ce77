"""The parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import ship

ROOT = "/srv/collector"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The table ``name`` of ``sf_dir``; only ``columns``, if any are given, reach the scan."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
