"""Joins, ranks and medians that no hot key can bring down to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import cut

#: Over how many tasks the rows of a key are spread where a key is hot by nature.
SALTS = 16
#: A table with at most so many rows, of a few short columns, is sent whole to all executors.
SMALL_ROWS = 200_000
#: One in so many rows of a group is the error of a quantile at most.
ACCURACY = 10_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` to be sent whole to all executors if a count shows that it is small; else as it is. ``df`` should be stored already (``cut``)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``left`` joined (left or inner) with ``right``, which has at most one row per key.

    One join, so ``left`` is computed once. Hot keys, null ones too, are split by AQE, which may do so on
    the left side of both kinds of join and copies the one row of ``right``. Null keys match nothing.
    Columns of ``right`` other than ``keys`` must not be in ``left``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"not for this kind of join: {how}")
    return left.join(right, keys, how)


def numbered(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds ``ordinal``, the position of a row in its group, and ``planned``, the size of the group.

    The rows are sorted by range, so a group may lie on many partitions; positions within a partition
    are shifted by the counts of those before. Null group keys form a group; ties are in no set order.
    """
    ranged = cut(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part", *by).agg(F.count("*").alias("_here"))
    group = Window.partitionBy(*by)
    before = F.sum("_here").over(group.orderBy("_part")) - F.col("_here")
    shifts = counts.select(F.col("_part").alias("_p"), *(F.col(b).alias(f"_{b}") for b in by), before.alias("_before"), F.sum("_here").over(group).alias("planned"))
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order)))
    same = F.col("_part") == F.col("_p")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_{b}"))
    return local.join(shifts, same).select(*df.columns, (F.col("_local") + F.col("_before")).alias("ordinal"), "planned")


def upper_medians(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """``by`` and the value at position ``n // 2`` of the sorted non-null values of each group, exactly.

    Quantiles with a proven error narrow each group down to a range around its median; values below it
    are counted and only those inside, combined by value, are ranked. Nothing is sorted as a whole. Null
    keys form a group; groups without values are left out.
    """
    rows = df.select(*(F.col(b).alias(f"_{b}") for b in by), F.col(value).alias("_value")).filter("_value is not null")
    keys = [f"_{b}" for b in by]
    ranges = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.percentile_approx("_value", [0.5 - 2 / ACCURACY, 0.5 + 2 / ACCURACY], ACCURACY).alias("_q"))
    around = ranges.select(*(F.col(k).alias(f"_{k}") for k in keys), "_n", F.col("_q")[0].alias("_low"), F.col("_q")[1].alias("_high"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    placed = rows.join(around, same).filter("_value <= _high").select(*keys, "_n", F.when(F.col("_value") >= F.col("_low"), F.col("_value")).alias("_value"))
    counts = placed.groupBy(*keys, "_n", "_value").agg(F.count("*").alias("_times"))  # null: all below the range
    upto = F.sum("_times").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_value")))
    middle = counts.withColumn("_upto", upto).filter((F.col("_upto") > F.floor(F.col("_n") / 2)) & F.col("_value").isNotNull())
    return middle.groupBy(*keys).agg(F.min("_value").alias(name)).select(*(F.col(f"_{b}").alias(b) for b in by), name)
