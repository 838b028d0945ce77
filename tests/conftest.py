from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tallyloom.session import local_session

    session = local_session(4, 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """The rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)

    return collect
