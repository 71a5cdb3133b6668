"""Calls of user-supplied models from Spark tasks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptmill.operators.skew import hash_rank

ChatFactory = Callable[[], Callable[[str, str], str]]
ScorerFactory = Callable[[], Callable[[pd.Series], object]]
# Prompts that a task holds as Python strings at a time.
SLICE = 256


@dataclass(frozen=True)
class Schedule:
    """Send times of a job: request ``number`` (from 0) is due ``number / rate`` seconds after ``begun``.

    Every request of a job has a number of its own, whatever task sends it and also when it is
    sent again, so all tasks together keep the rate. Requests that are late are sent by each
    of the ``callers`` no faster than its share of the rate allows.
    """

    begun: float
    rate: float
    callers: int

    def wait(self, number: int, last: float) -> float:
        """Seconds from now until a request may be sent whose sender sent its last one at ``last``."""
        return max(self.begun + number / self.rate, last + self.callers / self.rate) - time.time()


def send_slots(requests: DataFrame, callers: int, rate: float, id: str = "id", first: int = 0) -> DataFrame:
    """``requests`` with ``number`` (in the order of the md5 of their id), ``caller`` and ``due_seconds``.

    Numbers go round the callers, so the requests of each are due at even distances.
    """
    numbered = hash_rank(requests, id, name="number").withColumn("number", F.col("number") + (first - 1))
    return numbered.withColumn("caller", (F.col("number") % callers).cast("int")).withColumn(
        "due_seconds", F.col("number") / rate
    )


def call_model(
    prompts: DataFrame,
    factory: ChatFactory,
    *,
    keep: Sequence[str] = (),
    delay_seconds: float = 0.0,
    max_callers: int | None = None,
    schedule: Schedule | None = None,
    timed: bool = False,
) -> DataFrame:
    """(id, keep.., raw, call_error) for (id, keep.., system_message, user_message).

    ``factory`` runs once per partition and gives ``fn(system, user) -> text``.
    A failed call gives its message in ``call_error``. ``timed`` adds ``sent``, the time of the call
    in seconds of the epoch.
    ``delay_seconds`` is waited after each call; ``max_callers`` bounds the number of tasks that
    call at the same time. With a ``schedule`` prompts have ``number`` and ``caller`` of
    ``send_slots``; each caller is one task and sends its requests when they are due.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, last = None, 0.0
        for whole in batches:
            # Prompts are long: only those of a slice are Python strings at a time.
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                if model is None:
                    model = factory()
                numbers = batch.column("number").to_pylist() if schedule else []
                replies, errors, sent = [], [], []
                for at, (system, user) in enumerate(
                    zip(batch.column("system_message").to_pylist(), batch.column("user_message").to_pylist())
                ):
                    if schedule:
                        time.sleep(max(0.0, schedule.wait(numbers[at], last)))
                    last = time.time()
                    sent.append(last)
                    try:
                        replies.append(model(system, user))
                        errors.append(None)
                    except Exception as error:  # any client may raise anything
                        replies.append(None)
                        errors.append(f"{type(error).__name__}: {error}")
                    if delay_seconds:
                        time.sleep(delay_seconds)
                # Taken, so that what is handed on does not hold the prompts of the whole batch.
                about = [batch.column(name).take(pa.array(range(batch.num_rows))) for name in kept]
                answers = [pa.array(replies, pa.string()), pa.array(errors, pa.string())]
                times = [pa.array(sent, pa.float64())] if timed else []
                names = [*kept, "raw", "call_error", *(["sent"] if timed else [])]
                yield pa.RecordBatch.from_arrays([*about, *answers, *times], names=names)

    kept = ["id", *keep]
    if schedule:
        rows = prompts.select(*kept, "system_message", "user_message", "number", "caller")
        rows = rows.repartitionById(schedule.callers, F.col("caller")).sortWithinPartitions("number")
    else:
        rows = prompts.select(*kept, "system_message", "user_message")
        rows = rows.repartition(max_callers) if max_callers else rows
    types = dict(prompts.dtypes)
    schema = ", ".join(f"{name} {types[name]}" for name in kept)
    return rows.mapInArrow(run, f"{schema}, raw string, call_error string{', sent double' if timed else ''}")


def score_texts(texts: DataFrame, factory: ScorerFactory) -> DataFrame:
    """(id, logits, error) for (id, text) with a user-supplied classifier.

    ``factory`` runs once per partition and gives ``fn(texts) -> rows of logits``
    for an Arrow batch. When a batch fails, its texts are scored one by one, so
    only the failing ones get an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for batch in batches:
            if scorer is None:
                scorer = factory()
            try:
                logits = [list(map(float, row)) for row in scorer(batch["text"])]
                errors = [None] * len(logits)
            except Exception:
                logits, errors = [], []
                for i in range(len(batch)):
                    try:
                        logits.append(list(map(float, list(scorer(batch["text"].iloc[i : i + 1]))[0])))
                        errors.append(None)
                    except Exception as error:
                        logits.append(None)
                        errors.append(f"{type(error).__name__}: {error}")
            yield pd.DataFrame({"id": batch["id"], "logits": logits, "error": errors})

    id_type = dict(texts.dtypes)["id"]
    return texts.select("id", "text").mapInPandas(run, f"id {id_type}, logits array<double>, error string")
