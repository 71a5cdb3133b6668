"""One local session and a few small builders for the tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conceptmill.operators.graph import QUAD_SCHEMA  # noqa: E402
from conceptmill.session import build_session  # noqa: E402
from small_tables import uri  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def make_quads(spark):
    """Quads from (g, s, p, object) tuples; a plain string object is a URI."""

    def make(*rows):
        data = [(g, s, p, uri(o) if isinstance(o, str) else o) for g, s, p, o in rows]
        return spark.createDataFrame(data, QUAD_SCHEMA)

    return make
