"""Expected against actual inventories, and sets against sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.skew import join_unique


def expected_counts(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``expected``, ``actual`` (0 if there are none) and whether they agree. ``expected`` has ``keys`` and ``expected``."""
    counted = actual.groupBy(*keys).agg(F.count("*").alias("actual"))
    joined = expected.select(*keys, "expected").join(counted, keys, "left")
    return joined.select(*keys, "expected", F.coalesce("actual", F.lit(0)).alias("actual"), (F.col("expected") == F.coalesce("actual", F.lit(0))).alias("agrees"))


def mapped(files: DataFrame, series: DataFrame, group: str, label: str) -> DataFrame:
    """Files whose group is in scope, with ``mapping``: mapped, or unmapped if their label is unknown there.

    Files of other groups are left out. ``series`` has ``group``, ``label`` and what a label maps to.
    """
    in_scope = files.join(series.select(group).distinct(), group, "left_semi")
    joined = join_unique(in_scope, series.withColumn("mapped_here", F.lit(True)), [group, label])
    return joined.withColumn("mapping", F.when(F.col("mapped_here"), "mapped").otherwise("unmapped")).drop("mapped_here")


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("times")).filter("times > 1")


def first_match(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each group in the given order."""
    return rows.groupBy(*by).agg(F.min_by(F.struct(*(c for c in rows.columns if c not in by)), F.struct(*order)).alias("row")).select(*by, "row.*")


def unknown(requested: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """Requested values that are not available, each once; null is a value like any other."""
    return requested.select(key).subtract(available.select(key))


def same_set(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: how many distinct values are on one side only, and whether the sets are equal."""
    a = left.select(key).distinct().withColumn("l", F.lit(1))
    b = right.select(key).distinct().withColumn("r", F.lit(1))
    both = a.join(b, key, "full")
    return both.agg(F.count_if(F.col("r").isNull()).alias("only_left"), F.count_if(F.col("l").isNull()).alias("only_right")).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows that both pages have."""
    return left.intersect(right)


def filtered(df: DataFrame, **wanted: list | None) -> DataFrame:
    """Rows that meet all filters; None filters nothing, an unknown value or an empty result is an error."""
    out = df
    for name, values in wanted.items():
        if not values:
            continue
        known = {r[0] for r in df.filter(F.col(name).isin(*values)).select(name).distinct().collect()}
        if set(values) - known:
            raise ValueError(f"unknown {name}: {sorted(set(values) - known)}")
        out = out.filter(F.col(name).isin(*values))
    if any(wanted.values()) and out.limit(1).count() == 0:
        raise ValueError("the filters select nothing")
    return out


def select_scope(datasets: DataFrame, expected: dict[str, int], sources: list[str] | None = None, codes: list[str] | None = None) -> DataFrame:
    """The datasets of the wanted sources and codes, in order.

    Without ``codes`` each source must have its expected number of datasets; with them each code must
    be found. Unknown sources are an error.
    """
    wanted = sources or sorted(expected)
    if set(wanted) - set(expected):
        raise ValueError(f"unknown sources: {sorted(set(wanted) - set(expected))}")
    scope = datasets.filter(F.col("source").isin(*wanted))
    if codes:
        scope = scope.filter(F.col("domn_code").isin(*codes))
        lacking = set(codes) - {r.domn_code for r in scope.select("domn_code").distinct().collect()}
        if lacking:
            raise ValueError(f"codes not found: {sorted(lacking)}")
    else:
        found = {r.source: r["count"] for r in scope.groupBy("source").count().collect()}
        if any(found.get(s, 0) != expected[s] for s in wanted):
            raise ValueError(f"unexpected numbers of datasets: {found}")
    return scope.orderBy("source", "domn_code", "dataset")
