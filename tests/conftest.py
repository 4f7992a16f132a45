import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scoutlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, nulls first."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
