"""Every named query against its SQL on the smallest tables."""

import glob
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from conceptmill.plans import catalog


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def table(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in tuples), key=repr)


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"train_classifier", "classifier_annotation"}


@pytest.mark.parametrize("missing", ["xxhash", "corpus_pipeline", "conceptmill.llm"])
def test_other_queries_stay_when_something_is_missing(missing):
    code = (
        "import sys\n"
        f"sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as entry\n"
        "from conceptmill.plans import catalog\n"
        "assert set(catalog.QUERIES) <= set(entry.queries()), 'lost'\n"
    )
    root = os.path.dirname(os.path.abspath(entry.__file__))
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, check=True)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_its_sql(spark, sf, duck, name):
    got = entry.queries()[name](spark, sf)
    expected = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(columns)
    assert table(got.columns, got.collect()) == table(columns, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["decision", "text"]
