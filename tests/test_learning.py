"""Encodings, splits, predictions and metrics against plain Python."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from small_tables import rows
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.operators import learning as learn
from conceptmill.operators import prediction as pred
from conceptmill.operators.skew import hash_rank, hot_keys, members_without, salted_lookup, spread_join

IDS = [("a", 0), ("b", 1), ("c", 2)]
LABELLED = "decision string, classes array<string>"


@pytest.fixture(scope="module")
def ids(spark):
    return spark.createDataFrame(IDS, "label string, id bigint")


def test_repeated_label_gets_its_last_position(spark):
    codelist = spark.createDataFrame(
        [("s", "u1", "x", None), ("s", "u2", "y", None), ("s", "u3", "x", None)],
        "scheme string, uri string, label string, definition string",
    )
    assert rows(learn.label_ids(codelist), "label", "id") == [("x", 2), ("y", 1)]


def test_encodings_and_rejects(spark, ids):
    data = spark.createDataFrame([("e:1", ["c", "a"]), ("e:2", ["b"]), ("e:3", ["b", "zz"]), ("e:4", ["zz"])], LABELLED)
    assert rows(learn.single_label_ids(data, ids)) == [("e:1", "c", 2), ("e:2", "b", 1), ("e:3", "b", 1)]
    assert rows(learn.multi_hot(data, ids)) == [("e:1", [1.0, 0.0, 1.0]), ("e:2", [0.0, 1.0, 0.0])]
    assert rows(learn.multi_hot(data, ids, size=4))[0] == ("e:1", [1.0, 0.0, 1.0, 0.0])
    assert rows(learn.unknown_classes(data, ids)) == [("e:3", "zz"), ("e:4", "zz")]


def test_problem_type(spark):
    def kind(*classes):
        return learn.problem_type(spark.createDataFrame([("e", list(c)) for c in classes], LABELLED)).first()[0]

    assert kind(["a"], ["b"]) == v.SINGLE_LABEL
    assert kind(["a"], ["b", "c"]) == v.MULTI_LABEL
    with pytest.raises(ValueError):
        learn.check_problem_type("regression")


def labelled_rows(spark, counts):
    data = [(f"e:{label}:{i}", label) for label, n in counts.items() for i in range(n)]
    return spark.createDataFrame(data, "decision string, id bigint")


def test_stratified_split(spark):
    counts = {0: 200, 1: 95, 2: 14, 3: 2}
    got = learn.split_stratified(labelled_rows(spark, counts)).collect()
    total = sum(counts.values())
    tested = Counter(r["id"] for r in got if r["split"] == "test")
    assert len(got) == total and sum(tested.values()) == math.ceil(total / 10)
    for label, n in counts.items():
        assert abs(tested[label] - n / 10) < 1.1
    again = learn.split_stratified(labelled_rows(spark, counts).repartition(7)).collect()
    assert sorted(got) == sorted(again)


def test_quotas_of_billions(spark):
    counts = spark.createDataFrame([(0, 40_000_000_000), (1, 60_000_000_007)], "id bigint, n bigint")

    class Many:
        """Stands for a labelled table with these counts."""

        def select(self, *_):
            return self

        distinct = select

        def groupBy(self, *_):
            return self

        def agg(self, *_):
            return counts

    got = rows(learn.stratified_quotas(Many()), "id", "quota")
    assert got == [(0, 4_000_000_000), (1, 6_000_000_001)]


def test_split_falls_back_when_a_label_is_too_small(spark):
    got = learn.split_stratified(labelled_rows(spark, {0: 40, 1: 1})).collect()
    assert sum(r["split"] == "test" for r in got) == 5


def test_hash_rank_counts_without_gaps(spark):
    data = [(f"e{i}", "hot" if i % 3 else f"g{i % 5}") for i in range(600)]
    df = spark.createDataFrame(data, "uid string, grp string")
    by_group = {}
    for r in hash_rank(df, "uid", ["grp"]).collect():
        by_group.setdefault(r["grp"], []).append(r["rank"])
    assert all(sorted(x) == list(range(1, len(x) + 1)) for x in by_group.values())
    assert sorted(r["rank"] for r in hash_rank(df, "uid").collect()) == list(range(1, 601))


def test_spread_join_equals_plain_join(spark):
    left = spark.range(500).selectExpr("id AS row", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 11 AS STRING) END AS k")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("4", 3)], "k string, x int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        got = spread_join(left, right, ["k"], how, spread=["row"])
        assert got.columns[:2] == ["row", "k"]
        assert rows(got, *got.columns) == rows(left.join(right, ["k"], how), *got.columns)


def test_only_hot_keys_are_repeated(spark):
    left = spark.range(40_000).selectExpr(
        "id AS row", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE CAST(id AS STRING) END AS k"
    )
    right = spark.range(5000).selectExpr("CAST(id AS STRING) AS k", "id AS x").unionByName(
        spark.createDataFrame([("hot", -1)], "k string, x bigint")
    )
    hot = hot_keys(left, ["k"], 2000)
    share = {r["_salts"] for r in hot.collect()}
    assert len(share) == 2 and max(share) == 667  # 'hot' and null, as many salts as they fill partitions
    copies = dict(rows(salted_lookup(right, hot, ["k"]).groupBy("k").count(), "k", "count"))
    assert copies.pop("hot") == 667 and set(copies.values()) == {1}
    for how in ("left", "inner"):
        got = spread_join(left, right, ["k"], how, spread=["row"], parts=2000)
        assert got.groupBy().agg(F.count("x"), F.sum("x"), F.count("row")).collect() == (
            left.join(right, ["k"], how).groupBy().agg(F.count("x"), F.sum("x"), F.count("row")).collect()
        )


def test_no_key_is_hot_where_all_are_rare(spark):
    assert hot_keys(spark.range(100_000).selectExpr("id % 30000 AS k"), ["k"], 2000).isEmpty()
    assert hot_keys(spark.range(0).selectExpr("id AS k"), ["k"], 2000).isEmpty()


def test_members_without(spark):
    def of(*keys):
        return spark.createDataFrame([(k,) for k in keys], "k string")

    assert rows(members_without(of("a", "a", "b"), of("b", "c"), "k")) == [("a",)]


def test_single_prediction(spark):
    rng = random.Random(1)
    data = [(i, [rng.uniform(-4, 4) for _ in range(5)]) for i in range(60)] + [(60, [1.0, 1.0, 0.0, 1.0, 0.0]), (61, [900.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "i int, logits array<double>")
    for r in pred.predict(df, v.SINGLE_LABEL, threshold=0.45).collect():
        x = np.array(r["logits"])
        p = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
        want = [(int(p.argmax()), p.max())] if p.max() >= 0.45 else []
        got = [tuple(e) for e in r["predictions"]]
        assert [e[0] for e in got] == [e[0] for e in want]
        assert np.allclose([e[1] for e in got], [e[1] for e in want])


def test_threshold_is_inclusive_in_prediction_only(spark):
    df = spark.createDataFrame([([0.0, 2.0, -1.0],)], "logits array<double>")
    got = pred.predict(df, v.MULTI_LABEL, threshold=0.5, labels=F.array(F.lit("x"), F.lit("y"), F.lit("z"))).first()
    assert [e["label"] for e in got["predictions"]] == ["x", "y"]
    assert df.select(pred.evaluation_labels(F.col("logits"), v.MULTI_LABEL)).first()[0] == [0, 1, 0]


def weighted(truth, predicted):
    """Support-weighted scores from label indicator matrices."""
    tp, fp, fn = (truth * predicted).sum(0), ((1 - truth) * predicted).sum(0), (truth * (1 - predicted)).sum(0)
    support = tp + fn

    def ratio(a, b):
        return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)

    weigh = lambda s: float((s * support).sum() / support.sum()) if support.sum() else 0.0
    return [weigh(ratio(tp, tp + fp)), weigh(ratio(tp, tp + fn)), weigh(ratio(2 * tp, 2 * tp + fp + fn))]


def test_single_metrics(spark):
    rng = random.Random(3)
    data = [(rng.choice("xy"), rng.randrange(4), rng.choice([0, 0, 1, 5])) for _ in range(200)]
    df = spark.createDataFrame(data, "m string, truth int, predicted int")
    got = {r["m"]: r for r in pred.metrics(df, v.SINGLE_LABEL, by=["m"]).collect()}
    for m in "xy":
        t, p = np.array([d[1] for d in data if d[0] == m]), np.array([d[2] for d in data if d[0] == m])
        one_hot = lambda a: np.eye(6)[a]
        want = [(t == p).mean(), *weighted(one_hot(t), one_hot(p))]
        assert np.allclose([got[m][n] for n in ("accuracy", "precision", "recall", "f1")], want)
    assert len(pred.metrics(df.drop("m"), v.SINGLE_LABEL).collect()) == 1


def test_multi_metrics(spark):
    rng = random.Random(4)
    data = [([float(rng.random() < 0.3) for _ in range(3)] + [0.0], [int(rng.random() < 0.4) for _ in range(4)]) for _ in range(80)]
    df = spark.createDataFrame(data, "truth array<double>, predicted array<int>")
    t, p = np.array([d[0] for d in data]), np.array([d[1] for d in data])
    want = [(t == p).all(1).mean(), *weighted(t, p)]
    assert np.allclose(list(pred.metrics(df, v.MULTI_LABEL).first()), want)


def test_metrics_without_positives_are_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0], [0, 1])], "truth array<double>, predicted array<int>")
    assert list(pred.metrics(df, v.MULTI_LABEL).first()) == [0.0, 0.0, 0.0, 0.0]
