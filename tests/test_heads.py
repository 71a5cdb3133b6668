"""Heads of all labels fitted in common passes, the best epoch kept."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_jobs import training_graph
from test_selection import TASK

from conceptmill import vocab as v
from conceptmill.operators import classifier as clf
from conceptmill.plans import jobs


def corpus(spark, n_labels, n=400):
    texts = spark.range(n).select(
        F.concat(F.lit("word"), F.col("id") % n_labels, F.lit(" and filler"), F.col("id") % 7).alias("text"),
        (F.col("id") % n_labels).alias("label"),
    )
    hot = F.transform(F.sequence(F.lit(0), F.lit(n_labels - 1)), lambda i: (i == F.col("label")).cast("double"))
    return texts.select("text", hot.alias("target"), "label")


def passes_of(monkeypatch):
    calls, plain = [], clf.fit_heads
    monkeypatch.setattr(clf, "fit_heads", lambda *a, **k: calls.append(a[3:5]) or plain(*a, **k))
    return calls


@pytest.mark.parametrize("n_labels", [5, 200])
def test_many_labels_take_as_many_passes_as_few(spark, monkeypatch, n_labels):
    calls = passes_of(monkeypatch)
    data = corpus(spark, n_labels)
    model = clf.fit_classifier(data, [str(i) for i in range(n_labels)], v.MULTI_LABEL, num_features=1 << 18, epochs=4)
    assert calls == [(0, n_labels)]
    got = model.transform(data).select("label", "logits").collect()
    right = sum(int(np.argmax(r["logits"])) == r["label"] for r in got)
    assert right >= 0.98 * len(got)  # words may share a hash


def test_blocks_of_labels_are_what_all_labels_are(spark, monkeypatch):
    data, labels = corpus(spark, 12), [str(i) for i in range(12)]
    whole = clf.fit_classifier(data, labels, v.MULTI_LABEL, num_features=1 << 10, epochs=2)
    monkeypatch.setattr(clf, "MATRIX", 5 * (whole.used.size + 1))
    calls = passes_of(monkeypatch)
    parts = clf.fit_classifier(data, labels, v.MULTI_LABEL, num_features=1 << 10, epochs=2)
    assert calls == [(0, 5), (5, 5), (10, 2)]
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.intercepts, parts.intercepts)
    single = clf.fit_classifier(
        data.select("text", F.col("label").alias("target")), labels, v.SINGLE_LABEL, num_features=1 << 10, epochs=2
    )
    assert all(int(np.argmax(r["logits"])) == r["label"] for r in single.transform(data).collect())


def test_the_epoch_with_the_least_loss_is_kept(spark):
    data = corpus(spark, 4, 80).select("text", F.col("label").alias("target"))
    # The validation texts say the opposite, so every epoch after the first makes things worse.
    wrong = data.withColumn("target", (F.col("target") + 1) % 4)
    options = {"labels": list("abcd"), "problem": v.SINGLE_LABEL, "num_features": 1 << 10}
    kept = clf.fit_classifier(data, validation=wrong, epochs=4, **options)
    first = clf.fit_classifier(data, validation=wrong, epochs=1, **options)
    assert kept.losses == sorted(kept.losses) and len(kept.losses) == 4 and kept.losses[0] == pytest.approx(first.losses[0])
    assert np.allclose(kept.weights, first.weights) and np.allclose(kept.intercepts, first.intercepts)


def test_empty_texts(spark):
    data = spark.createDataFrame([("", 0), ("a", 1), ("  ", 0), ("a b", 1)], "text string, target int")
    model = clf.fit_classifier(data, ["x", "y"], v.SINGLE_LABEL, num_features=64, epochs=3)
    assert len(model.transform(data).collect()) == 4


def test_training_ends_in_metadata_and_report(make_quads):
    about = jobs.ModelAbout("m/1", "oid", "sha", "http://r", "http://r/tree", "http://code", datetime.datetime(2024, 5, 6, 7, 8))
    training = jobs.train_classifier(training_graph(make_quads, 60), TASK, about=about, num_features=1 << 10)
    report = training.report.first()["report"]
    assert "day: 2024-05-06" in report and "Accuracy: 1.0000" in report and "1. Clean Energy\n2. Climate Action" in report
    values = {r["s"]: r["o"]["value"] for r in training.metadata.where(F.col("p") == v.DQV + "value").collect()}
    assert len(values) == 5 and "1.0" in values.values()
