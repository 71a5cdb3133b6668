"""The near-copy operator moves and asks for what it needs, not for all texts and sets."""

import pytest
from pyspark.sql import functions as F

from conceptmill.llm import ngram_join

TEXT = "one two three four five six seven eight nine ten"


@pytest.mark.parametrize("bits", [ngram_join.FILTER_BITS, 7])
def test_rows_without_copies_stay_where_they_are(spark, monkeypatch, bits):
    """A filter that knows too many rows (7 bits) changes nothing, as a join decides on those it knows."""
    monkeypatch.setattr(ngram_join, "FILTER_BITS", bits)
    rows = [(1, TEXT), (2, TEXT), (2, TEXT), (3, TEXT + " eleven"), (None, TEXT), (5, None), (5, None), (None, "")]
    rows += [(i, " ".join(f"w{i}x{j}" for j in range(9))) for i in range(10, 60)] + [(10, " ".join(f"w10x{j}" for j in range(9)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = ngram_join.first_of_each(docs, n=2, percent=80)
    analyzed = got._jdf.queryExecution().analyzed().toString()
    assert "Filter NOT may_move" in analyzed, "all texts go through the join"
    key = str
    assert sorted(map(tuple, got.collect()), key=key) == sorted([(1, TEXT), (5, None), (5, None), (None, ""), *rows[8:-1]], key=key)


def test_later_rounds_ask_for_the_sets_of_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL_BUCKET", 1)
    asked = []

    def verified(pairs, sets, percent, real=ngram_join.verified):
        ends = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
        asked.append(({r["set_id"] for r in sets.select("set_id").collect()}, {r["set_id"] for r in ends.collect()}))
        return real(pairs, sets, percent)

    monkeypatch.setattr(ngram_join, "verified", verified)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"own{i}"])) for i in range(8)] + [(20 + i, " ".join([*base[:40], f"a{i}", *base[40:]])) for i in range(8)]
    rows += [(40, "p q r s"), (41, "p q r t u")]  # share a signature, but are too unlike in size to be a pair
    ngram_join.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(asked) > 1
    assert all(sets == ends for sets, ends in asked[1:])
    assert min(len(sets) for sets, _ in asked[1:]) < len(asked[0][0])


def test_classes_take_one_query_not_one_for_each_partition(spark):
    docs = spark.createDataFrame([(i, f"{TEXT} t{i}") for i in range(20)], "doc_id bigint, text string")
    scanned = ngram_join.written(ngram_join.scan(docs, 3), "shingles")
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    before = {key: spark.conf.get(key) for key in keys}
    context = spark.sparkContext
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        context.setJobGroup("classes", "classes of the sketch")
        ngram_join.frequency_classes(scanned)
        assert len(context.statusTracker().getJobIdsForGroup("classes")) <= 3
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)
