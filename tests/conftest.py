from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from revmap.schemas import MAPPING  # noqa: E402
from revmap.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def mapping(spark):
    """A mapping frame from (ID, name, GL account) rows."""

    def make(*rows):
        full = [(i, name, f"n{k}", "group", "invoice", gl) for k, (i, name, gl) in enumerate(rows)]
        return spark.createDataFrame(full, MAPPING)

    return make


@pytest.fixture
def revenue(spark):
    """A small revenue frame from (id, month, amount) rows."""

    def make(*rows):
        return spark.createDataFrame(list(rows), "id string, data_month string, amount double").selectExpr(
            "id", "date(data_month) AS data_month", "amount"
        )

    return make


@pytest.fixture
def rows():
    """The rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
