from __future__ import annotations

import datetime
import posixpath

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions.paths import canonical_path
from tallyloom.functions.times import as_utc, utc_time

ROOT = "/srv/collector"
SAME = [
    "data/raw/a/b.xml", "./data/raw/a/b.xml", " data/raw/a/b.xml\t", "data//raw/./a/b.xml", "data\\raw\\a\\b.xml", "/srv/collector/data/raw/a/b.xml", "file:///srv/collector/data/raw/a/b.xml",
    "FILE://localhost/srv/collector/data/raw/a/b.xml", "file:/srv/collector/data/raw/a/b.xml", "data/tmp/../raw/a/b.xml", "data/x/y/../../raw/a/b.xml", "../collector/data/raw/a/b.xml", "/srv/collector/./data/raw//a/b.xml",
]


def one(spark, paths):
    df = spark.createDataFrame([(n, p) for n, p in enumerate(paths)], "n int, p string")
    return [r[0] for r in df.orderBy("n").select(canonical_path(F.col("p"))).collect()]


def test_ways_of_writing(spark):
    assert set(one(spark, SAME)) == {"data/raw/a/b.xml"}


def test_significant(spark):
    assert one(spark, ["data/raw/A/b.xml", "data/raw/a/b.XML", "/other/place.xml", "/../x", "/.", "/", None, "", ROOT, "/srv/collectors/x"]) == ["data/raw/A/b.xml", "data/raw/a/b.XML", "/other/place.xml", "/x", "/", "/", None, "", "", "/srv/collectors/x"]


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["a", "b", ".", "..", "", "c.xml"]), min_size=1, max_size=8), min_size=1, max_size=20))
def test_like_posixpath(spark, parts):
    paths = ["/".join(p) for p in parts]
    wanted = []
    for p in paths:
        full = posixpath.normpath(p if p.startswith("/") else f"{ROOT}/{p}").replace("//", "/")
        wanted.append("" if full == ROOT else full.removeprefix(ROOT + "/") if full.startswith(ROOT + "/") else full)
    assert one(spark, paths) == wanted


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "America/New_York"])
def test_times(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2025-03-09T02:30:00Z", "2025-03-09T11:30:00+09:00", "2025-03-09T02:30:00.000000+00:00", " 2025-03-09 02:30:00 ", "2025-03-08T21:30:00-0500", "2025-03-09T02:30Z", "n/a", None, "2025"]
        df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
        got = [r[0] for r in df.orderBy("n").select(utc_time(F.col("t"))).collect()]
        assert got[:6] == [datetime.datetime(2025, 3, 9, 2, 30)] * 6
        assert got[6:] == [None, None, None]
        stamps = df.select(F.lit("2025-03-09T02:30:00Z").cast("timestamp").alias("t")).limit(1)
        assert stamps.select(as_utc(stamps, "t")).first()[0] == datetime.datetime(2025, 3, 9, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
