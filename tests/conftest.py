import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4, memory="6g", app="cohortweave-tests")
    yield session
    session.stop()


@pytest.fixture
def small_tasks(spark):
    """Three rows per task, so that every key of a test counts as hot."""
    spark.conf.set("spark.cohortweave.rowsPerTask", "3")
    yield spark
    spark.conf.unset("spark.cohortweave.rowsPerTask")


@pytest.fixture(scope="session")
def day():
    return dt.date.fromisoformat


def as_set(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="session")
def rows():
    return as_set
