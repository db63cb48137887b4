import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierflow.session import build_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", app="tests", spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return scratch_dir(spark, "test")


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
    return collect
