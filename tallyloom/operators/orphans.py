"""References to records that do not exist.

Each reference is one row of a child table: its table, id, key and time. The distinct non-null keys,
with their earliest time, go through one distributed left anti join against the live parent keys;
what is left is classified and joined back to the references. Only keys with a finding take part in
the join back, so AQE can send them whole if they are few; a key that many references share is
spread over ``SALTS`` tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16


def references(df: DataFrame, name: str, row_id: str, key: Column, time: Column, spell: Callable[[Column], Column] = lambda key: key) -> DataFrame:
    """The non-null references of one table. Repeated rows each count; extra columns are dropped.

    ``spell`` gives a key its one spelling; it must not turn a key into null.
    """
    return df.filter(key.isNotNull()).select(F.lit(name).alias("ref_table"), F.col(row_id).alias("ref_id"), spell(key).alias("ref_key"), time.alias("ref_time"))


def parents(df: DataFrame, key: Column, since: Column, deleted: Column, spell: Callable[[Column], Column] = lambda key: key) -> DataFrame:
    """One row per parent key: when its earliest row without a deletion was stored, null if all are deleted.

    A live row without a time counts as always there.
    """
    always = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    rows = df.filter(key.isNotNull()).select(spell(key).alias("ref_key"), F.when(deleted.isNull(), F.coalesce(since, always)).alias("since"))
    return rows.groupBy("ref_key").agg(F.min("since").alias("since"))


def orphans(refs: DataFrame, known: DataFrame, salts: int = SALTS) -> DataFrame:
    """Each orphan reference with its ``orphan_kind`` (missing, deleted, late) and ``period``.

    A reference without a time can be missing or deleted but never late, and its period is null.
    Empty tables give an empty result; against no parents every reference is missing.
    """
    keys = refs.groupBy("ref_key").agg(F.min("ref_time").alias("first_ref"))
    live = known.filter("since is not null")
    same = [keys.ref_key == live.ref_key, F.coalesce(live.since <= keys.first_ref, F.lit(True))]
    suspects = keys.join(live, same, "left_anti").select("ref_key")
    state = known.select("ref_key", "since", F.lit(True).alias("found"))
    judged = suspects.join(state, "ref_key", "left")
    spread = judged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = refs.withColumn("salt", F.pmod(F.xxhash64("ref_id"), F.lit(salts)).cast("int"))
    kind = F.when(F.col("found").isNull(), "missing").when(F.col("since").isNull(), "deleted").when(F.col("since") > F.col("ref_time"), "late")
    return (
        salted.join(spread, ["ref_key", "salt"])
        .select("ref_table", "ref_id", "ref_key", kind.alias("orphan_kind"), F.date_format("ref_time", "yyyy-MM").alias("period"))
        .filter("orphan_kind is not null")
    )


def orphan_counts(found: DataFrame) -> DataFrame:
    """The orphan references and their distinct keys per table, period and kind."""
    return found.groupBy("ref_table", "period", "orphan_kind").agg(F.count("*").alias("orphan_refs"), F.countDistinct("ref_key").alias("orphan_keys"))
