from __future__ import annotations

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.llm.packing import fill, first_fit, pack, pack_group


def brute(sizes, capacity):
    bins, out = [], []
    for s in sizes:
        at = next((n for n, used in enumerate(bins) if used + s <= capacity), len(bins))
        if at == len(bins):
            bins.append(0)
        bins[at] += s
        out.append(at)
    return out


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 30), st.lists(st.integers(0, 30), max_size=60))
def test_first_fit(capacity, sizes):
    sizes = [min(s, capacity) for s in sizes]
    assert first_fit(np.array(sizes, np.int64), capacity).tolist() == brute(sizes, capacity)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 20), st.lists(st.integers(0, 70), max_size=40))
def test_group(capacity, sizes):
    got = pack_group(pd.DataFrame({"item": range(len(sizes)), "tokens": sizes}, dtype="int64"), capacity)
    assert got.groupby("item")["tokens"].sum().to_dict() == dict(enumerate(sizes))
    loads = got.groupby("container_no")["tokens"].sum()
    assert (loads <= capacity).all() and sorted(loads.index) == list(range(len(loads)))
    for item, pieces in got.groupby("item"):
        if sizes[item] <= capacity:
            assert len(pieces) == 1 and pieces["piece_no"].tolist() == [0]
        else:
            assert sorted(pieces["piece_no"]) == list(range(1, -(-sizes[item] // capacity) + 1))
    if sum(sizes):
        assert len(loads) <= 1.7 * sum(sizes) / capacity + 1  # any first fit


def test_pack(spark, rows):
    sizes = [(n, (n * 37) % 100) for n in range(500)] + [(1, 50), (1, 50), (None, 5), (900, None), (901, -3), (902, 1000)]
    df = spark.createDataFrame(sizes, "doc_id long, tokens long").withColumns({"item": F.lit(1), "pack_group": F.lit(2)})
    kinds = spark.createDataFrame([("a", 64), ("b", 640), ("b", 640), ("none", 0), ("null", None)], "container_kind string, capacity_tokens int").withColumn("extra", F.lit(1))
    packed = pack(df, "doc_id", kinds, rows=500, group_items=100).cache()
    total = sum(max(0, t or 0) for _, t in sizes)
    assert rows(fill(packed), "container_kind", "tokens") == [("a", total), ("b", total)]
    assert packed.select("pack_group").distinct().count() == 5
    assert packed.filter("doc_id = 1").select("container_kind", "tokens").filter("tokens = 50").count() == 4
    assert all(r.filled_share > 0.85 for r in fill(packed).collect())
    assert packed.groupBy("container_kind", "pack_group", "container_no").agg(F.sum("tokens").alias("t"), F.first("capacity_tokens").alias("c")).filter("t > c").count() == 0
    assert pack(df.limit(0), "doc_id", kinds, 0).count() == 0
    assert pack(df, "doc_id", kinds.limit(0), 500).count() == 0


def test_one_item_many_times(spark, rows):
    df = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(10).cast("long").alias("tokens"))
    kinds = spark.createDataFrame([(f"k{n}", 100 + n % 2) for n in range(1500)], "container_kind string, capacity_tokens int")
    packed = pack(df, "doc_id", kinds.limit(3), rows=3000, group_items=500).cache()
    sizes = [r["count"] for r in packed.filter("container_kind = 'k0'").groupBy("pack_group").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 700 and sum(sizes) == 3000
    assert rows(fill(packed), "container_kind", "tokens") == [(f"k{n}", 30_000) for n in range(3)]
    assert pack(df.limit(2), "doc_id", kinds, rows=2).select("container_kind").distinct().count() == 1500
