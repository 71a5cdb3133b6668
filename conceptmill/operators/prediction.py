"""From logits to labels, and evaluation of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.operators.learning import check_problem_type


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits, shifted by the largest one."""
    powers = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(powers, lambda x: x / total)


def argmax(values: Column) -> Column:
    """0-based place of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def predict(
    scored: DataFrame,
    problem: str,
    *,
    threshold: Column | float = v.DEFAULT_THRESHOLD,
    logits: str = "logits",
    labels: Column | None = None,
) -> DataFrame:
    """Add ``predictions``, an array of (label id or label, confidence).

    Single-label: the most probable label if it reaches the threshold.
    Multi-label: every label whose sigmoid reaches it. ``labels`` is an array
    that names the places.
    """
    check_problem_type(problem)
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))

    def entry(place: Column, confidence: Column) -> Column:
        label = place if labels is None else F.get(labels, place)
        return F.struct(label.alias("label"), confidence.alias("confidence"))

    if problem == v.SINGLE_LABEL:
        rows = scored.withColumn("_p", softmax(F.col(logits)))
        best = F.array(entry(argmax(F.col("_p")), F.array_max("_p")))
        found = F.filter(best, lambda e: e["confidence"] >= limit)
        return rows.withColumn("predictions", found).drop("_p")
    entries = F.transform(F.col(logits), lambda x, i: entry(i, sigmoid(x)))
    return scored.withColumn("predictions", F.filter(entries, lambda e: e["confidence"] >= limit))


def evaluation_labels(logits: Column, problem: str) -> Column:
    """Predicted id (single) or 0/1 array (multi, strictly above one half)."""
    if check_problem_type(problem) == v.SINGLE_LABEL:
        return argmax(logits)
    return F.transform(logits, lambda x: (sigmoid(x) > 0.5).cast("int"))


def _weighted(per_label: DataFrame, by: list[str]) -> DataFrame:
    """Support-weighted precision, recall and F1 from (label, tp, fp, fn)."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def ratio(over: Column, under: Column) -> Column:
        return F.when(under > 0, over / under).otherwise(F.lit(0.0))

    support = tp + fn
    total = F.sum(support)
    weigh = lambda score: F.coalesce(F.try_divide(F.sum(score * support), total), F.lit(0.0))
    return per_label.groupBy(*by).agg(
        weigh(ratio(tp, tp + fp)).alias("precision"),
        weigh(ratio(tp, tp + fn)).alias("recall"),
        weigh(ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    )


def single_label_metrics(judged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, f1 of (truth, predicted) ids, per ``by`` columns."""
    by = list(by)
    cells = judged.groupBy(*by, "truth", "predicted").agg(F.count(F.lit(1)).alias("n"))
    sides = F.explode(
        F.when(
            F.col("truth") == F.col("predicted"),
            F.array(F.struct(F.col("truth").alias("label"), F.col("n").alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.lit(0).cast("bigint").alias("fn"))),
        ).otherwise(
            F.array(
                F.struct(F.col("truth").alias("label"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.col("n").alias("fn")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("fp"), F.lit(0).cast("bigint").alias("fn")),
            )
        )
    )
    per_label = (
        cells.select(*by, sides.alias("side"))
        .select(*by, "side.*")
        .groupBy(*by, "label")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    )
    hits = F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(F.lit(0)))
    accuracy = cells.groupBy(*by).agg((hits / F.sum("n")).alias("accuracy"))
    scores = _weighted(per_label, by)
    joined = accuracy.join(scores, by) if by else _beside(accuracy, scores)
    return joined.select(*by, "accuracy", "precision", "recall", "f1")


def multi_label_metrics(judged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same for 0/1 arrays; accuracy asks for the whole row to be right."""
    by = list(by)
    pairs = judged.select(*by, F.posexplode(F.arrays_zip("truth", "predicted")).alias("label", "pair"))
    t, p = F.col("pair.truth") > 0, F.col("pair.predicted") > 0
    per_label = pairs.groupBy(*by, "label").agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn")
    )
    same = F.transform("truth", lambda x: x.cast("int")) == F.transform("predicted", lambda x: x.cast("int"))
    accuracy = judged.groupBy(*by).agg(F.avg(same.cast("double")).alias("accuracy"))
    scores = _weighted(per_label, by)
    joined = accuracy.join(scores, by) if by else _beside(accuracy, scores)
    return joined.select(*by, "accuracy", "precision", "recall", "f1")


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Put two one-row results side by side."""
    key = F.lit(1).alias("_one")
    return left.select("*", key).join(right.select("*", key), "_one").drop("_one")


def metrics(judged: DataFrame, problem: str, by: Sequence[str] = ()) -> DataFrame:
    compute = single_label_metrics if check_problem_type(problem) == v.SINGLE_LABEL else multi_label_metrics
    return compute(judged, by)
