"""Tables with an index: appends find known keys in the buckets they touch."""

import pytest
from pyspark.sql import functions as F
from small_tables import lit, rows

from conceptmill.session import scratch_path
from conceptmill.sources import quads as src
from conceptmill.sources.keyed import KeyedTable
from conceptmill.sources.tables import read_table_or_empty

SCHEMA = "k string, part string, text string"


@pytest.fixture
def path(spark):
    return scratch_path(spark, "keyed-test")


def of(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def stored(spark, path):
    return rows(read_table_or_empty(spark, path, SCHEMA))


def index_files(table, spark):
    state = read_table_or_empty(spark, f"{table.path}-index/state", "n_buckets int, n_rows bigint, settled boolean").first()
    return state, table._read(spark, state["n_buckets"]).withColumn("file", F.input_file_name())


@pytest.mark.parametrize("hashed", [True, False])
def test_append_adds_what_is_missing(spark, path, hashed):
    table = KeyedTable(path, SCHEMA, ["k", "part"], ["k"], hashed=hashed)
    table.append(of(spark, ("a", "1", "x"), ("a", "1", "w"), ("b", None, "y")))
    assert stored(spark, path) == rows(of(spark, ("a", "1", "w"), ("b", None, "y")))
    table.append(of(spark, ("a", "1", "new"), ("a", "2", "z"), ("c", "1", "v")))
    table.append(of(spark, ("c", "1", "again")))
    table.append(of(spark))
    assert {r[:2] for r in stored(spark, path)} == {("a", "1"), ("a", "2"), ("b", None), ("c", "1")}
    assert len(stored(spark, path)) == 4
    if not hashed:
        assert rows(table.held(of(spark, ("a", "", ""), ("q", "", "")))) == [("a", "1"), ("a", "2")]


def test_an_append_reads_one_file_for_each_bucket_whatever_is_stored(spark, path):
    table = KeyedTable(path, SCHEMA, ["k"], ["k"], rows_per_bucket=50)
    one = of(spark, ("k7", "", ""))
    read = []
    for start in range(0, 6000, 1500):
        table.append(spark.range(start, start + 1500).selectExpr("concat('k', id) AS k", "'p' AS part", "'t' AS text"))
        state, files = index_files(table, spark)
        near = table._near(one, state)
        read.append((near.select(F.input_file_name()).distinct().count(), near.count()))
        assert files.select("file").distinct().count() == files.select("bucket").distinct().count()
        assert (state["n_rows"], state["settled"]) == (start + 1500, True)
    assert {n for n, _ in read} == {1} and max(n for _, n in read) <= 4 * 50
    assert all(f"{path}-index/of-" in file for file in table._near(one, state).inputFiles())
    assert len(stored(spark, path)) == 6000


def test_an_index_that_did_not_follow_is_made_anew(spark, path):
    table = KeyedTable(path, SCHEMA, ["k"], ["k"])
    table.append(of(spark, ("a", "", "")))
    table._mark(spark, 16, 1, False)  # stopped between the table and its index
    of(spark, ("b", "", "")).write.mode("append").parquet(path)
    table.append(of(spark, ("a", "", ""), ("b", "", ""), ("c", "", "")))
    assert [r[0] for r in stored(spark, path)] == ["a", "b", "c"]
    assert index_files(table, spark)[0]["n_rows"] == 3


def test_an_index_without_its_table_counts_for_nothing(spark, path):
    table = KeyedTable(path, SCHEMA, ["k"], ["k"])
    of(spark, ("a", "", "")).write.parquet(f"{path}-index/of-16/bucket=3")
    table._mark(spark, 16, 1, True)
    table.append(of(spark, ("a", "", ""), ("b", "", "")))
    table.append(of(spark, ("a", "", "")))
    assert [r[0] for r in stored(spark, path)] == ["a", "b"]


def test_quads_written_before_there_was_an_index(spark, path, make_quads):
    first = make_quads(("g", "s", "p:1", "o"), ("g", "s", "p:1", lit("o")), ("g", "s", "p:1", lit("o", "nl")))
    src.write_quads(first, path)
    src.append_quads(first.unionByName(make_quads(("g", "s", "p:2", "o"), ("h", "s", "p:1", "o"))), path)
    src.append_quads(first, path)
    assert src.read_quads(spark, path).count() == 5
