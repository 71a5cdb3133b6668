"""Arrow batches of whole texts stay small, whatever the session says."""

from __future__ import annotations

import pyarrow as pa

from conceptmill.llm import ngram_join, quality_rules
from conceptmill.llm.common import BATCH_ROWS, slices, small_batches

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def largest(df):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return max(r["n"] for r in df.mapInArrow(sizes, "n bigint").collect())


def test_batches_are_small_inside_and_as_before_after(spark, monkeypatch):
    before = spark.conf.get(KEY)
    rows = spark.range(3000).coalesce(1)
    try:
        for value, inside in (("10000", BATCH_ROWS), ("0", BATCH_ROWS), ("100", 100)):
            spark.conf.set(KEY, value)
            with small_batches(spark):
                assert largest(rows) == inside
            assert spark.conf.get(KEY) == value
        spark.conf.set(KEY, "10000")
        held = []
        monkeypatch.setattr(ngram_join, "written", lambda df, name, real=ngram_join.written: held.append(spark.conf.get(KEY)) or real(df, name))
        docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, None)], "doc_id bigint, text string")
        got = sorted(map(tuple, ngram_join.link_documents(docs).collect()))
        assert got == [(1, 2, 1), (2, 2, 1), (3, 0, 3)]
        assert held and set(held) == {str(BATCH_ROWS)}
        assert spark.conf.get(KEY) == "10000"
    finally:
        spark.conf.set(KEY, before)


def test_quality_takes_texts_in_slices(spark, monkeypatch):
    batch = pa.RecordBatch.from_pydict({"n": list(range(2 * BATCH_ROWS + 7))})
    assert [b.num_rows for b in slices([batch, batch.slice(0, 0)])] == [BATCH_ROWS, BATCH_ROWS, 7]
    assert pa.Table.from_batches(slices([batch])).column(0).to_pylist() == batch.column(0).to_pylist()
    seen = spark.sparkContext.accumulator(0)

    def measures(column, memory, ratios, threshold):
        if len(column) > BATCH_ROWS:
            seen.add(1)
        return [pa.array([True] * len(column))]

    monkeypatch.setattr(quality_rules, "_measures", measures)
    before = spark.conf.get(KEY)
    try:
        spark.conf.set(KEY, "10000")
        docs = spark.range(1500).selectExpr("id AS doc_id", "'a b' AS text").coalesce(1)
        labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
        assert quality_rules.keep_good(docs, labels).count() == 1500
        assert seen.value == 0
    finally:
        spark.conf.set(KEY, before)
