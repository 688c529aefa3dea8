import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from chatmeter.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples; null sorts first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        tuples = [tuple(row) for row in picked.collect()]
        return sorted(tuples, key=lambda t: [(v is not None, v) for v in t])

    return collect
