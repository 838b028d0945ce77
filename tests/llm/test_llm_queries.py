from __future__ import annotations

from pathlib import Path

import pytest

from tallyloom.llm import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.mark.parametrize("name", queries.QUERIES)
def test_runs(spark, name):
    df = queries.QUERIES[name](spark, str(DATA))
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)
