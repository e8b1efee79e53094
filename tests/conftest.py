import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def as_of():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(frame, *order):
    return [tuple(r) for r in (frame.orderBy(*order) if order else frame).collect()]
