"""Every core query: against its SQL, or that it runs."""

from __future__ import annotations

import pytest

from comparison import DATA, same
from tallyloom.plans import collection, problems, readers, star

SLATES = [collection, star, readers, problems]
WITH_SQL = [(n, s) for s in SLATES for n in s.SQL]
WITHOUT = [(n, s) for s in SLATES for n in s.QUERIES if n not in s.SQL]
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.mark.parametrize("name,slate", WITH_SQL, ids=[n for n, _ in WITH_SQL])
def test_sql(spark, name, slate):
    same(spark, slate.QUERIES[name], slate.SQL[name])


#: What the smallest tables may have no case of.
RARE = {"p1_quarantine", "p1_alternatives"}


@pytest.mark.parametrize("name,slate", WITHOUT, ids=[n for n, _ in WITHOUT])
def test_runs(spark, name, slate):
    assert slate.QUERIES[name](spark, str(DATA)).count() > 0 or name in RARE


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["ref_table", "ref_id", "orphan_kind", "period"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_over_all_rows(spark):
    files = spark.read.parquet(str(DATA / "kess_files.parquet")).count()
    assert collection.QUERIES["order_ranked"](spark, str(DATA)).count() == files
    found = star.QUERIES["star_expected_nations"](spark, str(DATA)).collect()
    assert sum(r.actual for r in found) == spark.read.parquet(str(DATA / "nation.parquet")).count() and len({r.expected for r in found}) == len(found)
