from __future__ import annotations

import datetime
import random

from pyspark.sql import functions as F

from tallyloom.operators.orphans import orphan_counts, orphans, parents, references

REF = "id long, key string, at timestamp_ntz"
PAR = "key string, since timestamp_ntz, gone timestamp_ntz"


def day(n):
    return None if n is None else datetime.datetime(2025, 1, 1) + datetime.timedelta(days=n)


def run(spark, refs, known):
    r = references(spark.createDataFrame(refs, REF).withColumns({"ref_key": F.lit("x"), "salt": F.lit(1)}), "t", "id", F.col("key"), F.col("at"))
    p = parents(spark.createDataFrame(known, PAR).withColumn("found", F.lit(1)), F.col("key"), F.col("since"), F.col("gone"))
    return orphans(r, p)


def brute(refs, known):
    out = []
    for i, key, at in refs:
        if key is None:
            continue
        own = [k for k in known if k[0] == key]
        live = [k for k in own if k[2] is None]
        if not own:
            kind = "missing"
        elif not live:
            kind = "deleted"
        elif at is not None and all(k[1] is not None and k[1] > at for k in live):
            kind = "late"
        else:
            continue
        out.append(("t", i, kind, at and at.strftime("%Y-%m")))
    return sorted(out, key=repr)


def test_against_brute_force(spark, rows):
    random.seed(1)
    keys = ["hot"] * 20 + [f"k{n}" for n in range(12)] + [None]
    refs = [(n, random.choice(keys), day(random.choice([None, *range(80)]))) for n in range(300)]
    known = [(random.choice(keys[20:30] + ["hot"]), day(random.choice([None, *range(60)])), day(random.choice([None, None, 5]))) for n in range(25)]
    assert rows(run(spark, refs, known), "ref_table", "ref_id", "orphan_kind", "period") == brute(refs, known)
    again = refs + refs[:50]
    assert rows(run(spark, again, known), "ref_table", "ref_id", "orphan_kind", "period") == brute(again, known)


def test_empty_tables(spark, rows):
    assert rows(run(spark, [], [("a", day(1), None)])) == []
    assert rows(run(spark, [(1, "a", None), (2, None, day(1))], []), "ref_id", "orphan_kind", "period") == [(1, "missing", None)]
    counts = orphan_counts(run(spark, [(1, "a", day(1)), (2, "a", day(2)), (3, "b", day(3))], []))
    assert rows(counts) == [("t", "2025-01", "missing", 3, 2)]
