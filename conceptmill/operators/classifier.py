"""A text classifier: hashed term weights of Spark ML, logistic heads of all labels fitted together."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.operators.learning import check_problem_type
from conceptmill.sources.tables import materialised

NEVER = -1e9
# Texts of one step, and numbers of a weight matrix that one set of passes fits (64 MB).
BATCH, MATRIX = 32, 1 << 23
# Bytes of changes that a task averages, about.
AVERAGED = 1 << 24


@dataclass
class TextClassifier:
    """Fitted features, labels in id order, and one weight matrix for all logits.

    ``weights`` has a row for each feature that training has seen (``used``, at most the
    number of hashed features) and a column for each logit.
    """

    problem: str
    labels: list[str]
    features: PipelineModel
    used: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray
    losses: list[float] = field(default_factory=list)

    def transform(self, texts: DataFrame) -> DataFrame:
        """Add ``logits``, one per label, in one pass; a label without training rows never wins."""
        rows = self.features.transform(texts).drop("words", "counts")
        model = texts.sparkSession.sparkContext.broadcast((self.used, self.weights, self.intercepts))

        @F.pandas_udf("array<double>")
        def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            used, weights, intercepts = model.value
            for places, values in batches:
                out = []
                for at, value in zip(places, values):
                    row = np.searchsorted(used, at)
                    row[row == used.size] = 0
                    known = used[row] == at if used.size else np.zeros(len(at), bool)
                    out.append(np.asarray(value)[known] @ weights[row[known]] + intercepts)
                yield pd.Series(out)

        vector = F.unwrap_udt("features")
        return rows.withColumn("logits", score(vector["indices"], vector["values"])).drop("features")

    def save(self, path: str) -> None:
        """Write the model as tables below a new path."""
        spark = SparkSession.active()
        self.features.save(f"{path}/features")
        rows = [(int(i), w.astype(float).tolist()) for i, w in zip(self.used, self.weights)]
        spark.createDataFrame(rows, "feature bigint, weights array<double>").write.parquet(f"{path}/weights")
        about = json.dumps({"problem": self.problem, "labels": self.labels, "intercepts": self.intercepts.tolist(), "losses": self.losses})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/about")

    @classmethod
    def load(cls, path: str) -> TextClassifier:
        spark = SparkSession.active()
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        rows = sorted(spark.read.parquet(f"{path}/weights").collect())
        intercepts = np.array(about["intercepts"])
        weights = np.array([r["weights"] for r in rows], np.float32).reshape(-1, intercepts.size)
        used = np.array([r["feature"] for r in rows], np.int64)
        return cls(about["problem"], about["labels"], PipelineModel.load(f"{path}/features"), used, weights, intercepts, about["losses"])


@dataclass
class Head:
    """Weights of some labels over the used features (row by row), and their intercepts as the last row."""

    table: np.ndarray

    def logits(self, places: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row for each text, whose features begin at ``starts``."""
        total = np.repeat(self.table[-1:], starts.size, axis=0)
        sizes = np.diff(np.append(starts, places.size))
        some = sizes > 0
        if some.any():
            total[some] += np.add.reduceat(self.table[places] * values[:, None], starts[some], axis=0)
        return total


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and where the list of each row begins (one more at the end)."""
    starts = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[starts[0] : starts[-1]], starts - starts[0]


def _batches(batches: Iterator[pa.RecordBatch], used: np.ndarray, n_labels: int, first: int) -> Iterator[tuple]:
    """(places, values, starts, owner, targets) of BATCH texts at a time, features as rows of a head's table.

    Lists are taken flat from Arrow and features looked up by their number, so that no value is a Python object.
    """
    place_of = np.full(int(used[-1]) + 2 if used.size else 1, -1)
    place_of[used] = np.arange(used.size)
    for batch in batches:
        (at, begin), (value, _), (ids, ids_begin) = map(_flat, batch.columns)
        place = place_of[np.minimum(at, place_of.size - 1)]  # the last entry is of no used feature
        known = place >= 0
        place, value = place[known], value[known].astype(float)
        begin = np.append(0, np.cumsum(known))[begin]
        for start in range(0, batch.num_rows, BATCH):
            end = min(start + BATCH, batch.num_rows)
            low, high = begin[start], begin[end]
            owner = np.repeat(np.arange(end - start), np.diff(begin[start : end + 1]))
            truth = np.zeros((end - start, n_labels))
            row = np.repeat(np.arange(end - start), np.diff(ids_begin[start : end + 1]))
            label = ids[ids_begin[start] : ids_begin[end]].astype(np.int64) - first
            here = (label >= 0) & (label < n_labels)
            truth[row[here], label[here]] = 1.0
            yield place[low:high], value[low:high], begin[start:end] - low, owner, truth


def _probabilities(logits: np.ndarray, single: bool) -> np.ndarray:
    if single:
        raised = np.exp(logits - logits.max(axis=1, keepdims=True))
        return raised / raised.sum(axis=1, keepdims=True)
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def _learned(
    batches: Iterator[pa.RecordBatch], used: np.ndarray, table: np.ndarray, first: int, single: bool, rate: float, decay: float
) -> Iterator[pa.RecordBatch]:
    """What a partition's texts change, in steps of BATCH texts: one row for each feature it has."""
    head, before = Head(table.copy()), table
    power, touched, n = np.full(table.shape, 1e-8), np.zeros(len(table), bool), 0
    order = np.empty(len(table), np.int64)
    for places, values, starts, owner, truth in _batches(batches, used, table.shape[1], first):
        off = (_probabilities(head.logits(places, values, starts), single) - truth) / len(truth)
        rows = np.unique(np.append(places, len(table) - 1))
        order[rows] = np.arange(rows.size)
        inverse, gradient = order[places], np.empty((rows.size, table.shape[1]))
        for label in range(table.shape[1]):
            gradient[:, label] = np.bincount(inverse, weights=values * off[owner, label], minlength=rows.size)
        gradient[-1] += off.sum(axis=0)
        gradient[:-1] += decay * head.table[rows[:-1]] / len(truth)
        power[rows] += gradient**2
        head.table[rows] -= rate * gradient / np.sqrt(power[rows])
        touched[rows], n = True, n + len(truth)
    at = np.flatnonzero(touched)
    change = (head.table[at] - before[at]).astype("<f8")
    yield pa.RecordBatch.from_pydict(
        {
            "at": pa.array(at, pa.int64()),
            "n": pa.array(np.full(at.size, n), pa.int64()),
            "change": pa.array([row.tobytes() for row in change], pa.binary()),
        }
    )


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean change of each feature over the partitions that have it, by their texts; rows come sorted by feature."""

    def means(at: np.ndarray, total: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
        mean = total / weight[:, None]
        return pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array([row.tobytes() for row in mean], pa.binary())], names=["at", "change"]
        )

    last = None  # sums of a feature that the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        at, n = batch.column("at").to_numpy(), batch.column("n").to_numpy().astype(float)
        change = np.frombuffer(b"".join(batch.column("change").to_pylist()), "<f8").reshape(at.size, -1)
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        at, total, weight = at[starts], np.add.reduceat(change * n[:, None], starts), np.add.reduceat(n, starts)
        if last is not None and last[0][0] == at[0]:
            total[0] += last[1][0]
            weight[0] += last[2][0]
        elif last is not None:
            yield means(*last)
        yield means(at[:-1], total[:-1], weight[:-1])
        last = at[-1:], total[-1:], weight[-1:]
    if last is not None:
        yield means(*last)


def _loss(batches: Iterator[pa.RecordBatch], used: np.ndarray, table: np.ndarray, first: int, single: bool) -> Iterator[pa.RecordBatch]:
    head, total, n = Head(table), 0.0, 0
    for places, values, starts, _, truth in _batches(batches, used, table.shape[1], first):
        share = np.clip(_probabilities(head.logits(places, values, starts), single), 1e-12, 1 - 1e-12)
        costs = truth * np.log(share) if single else truth * np.log(share) + (1 - truth) * np.log(1 - share)
        total, n = total - float(costs.sum()), n + len(truth)
    yield pa.RecordBatch.from_pydict({"loss": pa.array([total]), "n": pa.array([n], pa.int64())})


def fit_heads(
    examples: DataFrame,
    validation: DataFrame | None,
    used: np.ndarray,
    first: int,
    n_labels: int,
    single: bool,
    *,
    epochs: int,
    rate: float,
    regularisation: float,
) -> tuple[np.ndarray, list[float]]:
    """(table, losses): the weights of ``n_labels`` labels from ``first`` on, all fitted in the same passes.

    ``examples`` and ``validation`` are (indices, values, ids). An epoch is one pass: every
    partition takes steps of BATCH texts from the shared weights and gives what it has
    changed, feature by feature; the mean of these changes, by numbers of texts, is the next weights. After each
    epoch the loss over ``validation`` is taken; the epoch with the least is kept, without it the last.
    """
    context, n_tasks = examples.sparkSession.sparkContext, examples.rdd.getNumPartitions()
    # Every task may change every weight; what one task averages has a fixed size.
    most = int(examples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_parts = max(1, min(most, math.ceil(n_tasks * (used.size + 1) * n_labels * 8 / AVERAGED)))
    table, best, losses = np.zeros((used.size + 1, n_labels)), None, []
    for _ in range(epochs):
        shared = context.broadcast((used, table))  # MATRIX numbers at most

        def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            return _learned(batches, *shared.value, first, single, rate, regularisation)

        changes = examples.mapInArrow(learn, "at bigint, n bigint, change binary")
        means = (
            changes.repartition(n_parts, "at").sortWithinPartitions("at", "n", "change")
            .mapInArrow(_averaged, "at bigint, change binary").toArrow()
        )
        table = table.copy()
        if means.num_rows:
            table[means.column("at").to_numpy()] += np.stack([np.frombuffer(x, "<f8") for x in means.column("change").to_pylist()])
        if validation is None:
            best = table
            continue
        judged = context.broadcast((used, table))

        def judge(batches: Iterator[pa.RecordBatch], judged=judged) -> Iterator[pa.RecordBatch]:
            return _loss(batches, *judged.value, first, single)

        sums = validation.mapInArrow(judge, "loss double, n bigint").groupBy().agg(F.sum("loss"), F.sum("n")).first()
        losses.append(sums[0] / sums[1] if sums[1] else 0.0)
        if best is None or losses[-1] < min(losses[:-1]):
            best = table
    return table if best is None else best, losses


def fit_classifier(
    training: DataFrame,
    labels: Sequence[str],
    problem: str,
    *,
    validation: DataFrame | None = None,
    num_features: int = 1 << 18,
    epochs: int = 10,
    rate: float = 0.5,
    regularisation: float = 1e-4,
) -> TextClassifier:
    """Fit on (text, target): a label id for single-label, a 0/1 array for multi-label.

    All labels are fitted in the same passes (see ``fit_heads``), one for each epoch, as long as
    the weights of used features and labels are MATRIX numbers at most, which the driver and every task hold.
    Beyond that the labels are cut into blocks of that size, each with its passes; in a
    single-label problem every label of a block is then fitted against the rest.
    ``validation`` decides which epoch is kept; ``losses`` has its loss after each (of the last block).
    """
    check_problem_type(problem)
    stages = [
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=num_features),
        IDF(inputCol="counts", outputCol="features"),
    ]
    features = Pipeline(stages=stages).fit(training)
    vector = F.unwrap_udt("features")
    target = F.col("target")
    if problem == v.SINGLE_LABEL:
        ids = F.array(target.cast("int"))
    else:
        hits = F.transform(target, lambda x, i: F.when(x > 0, i))
        ids = F.filter(hits, lambda i: i.isNotNull())

    def ready(rows: DataFrame, name: str) -> DataFrame:
        # Written once: every epoch reads it, and its files stand for the partitions.
        return materialised(
            features.transform(rows).select(vector["indices"].alias("indices"), vector["values"].alias("values"), ids.alias("ids")),
            name,
        )

    examples = ready(training, "training-features")
    judged = None if validation is None else ready(validation, "validation-features")
    used = np.sort(columns_of(examples.select(F.explode("indices").alias("at")).distinct(), "at"))  # num_features at most
    seen = np.sort(columns_of(examples.select(F.explode("ids").alias("at")).distinct(), "at"))
    width = max(1, min(len(labels), MATRIX // (used.size + 1)))
    single = problem == v.SINGLE_LABEL and width == len(labels)
    tables, losses = [], []
    for first in range(0, len(labels), width):
        table, losses = fit_heads(
            examples, judged, used, first, min(width, len(labels) - first), single,
            epochs=epochs, rate=rate, regularisation=regularisation,
        )
        tables.append(table.astype(np.float32))
    whole = np.concatenate(tables, axis=1) if tables else np.zeros((used.size + 1, 0), np.float32)
    intercepts = whole[-1].astype(float)
    intercepts[np.setdiff1d(np.arange(len(labels)), seen)] = NEVER
    weights = whole[:-1].copy()
    weights[:, intercepts == NEVER] = 0
    return TextClassifier(problem, list(labels), features, used, weights, intercepts, losses)


def columns_of(rows: DataFrame, name: str) -> np.ndarray:
    return rows.toArrow().column(name).to_numpy().astype(np.int64)
