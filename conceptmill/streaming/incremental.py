"""Incremental labelling of newly arriving decisions."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from conceptmill import vocab as v
from conceptmill.operators.writes import ANNOTATION_KEY
from conceptmill.plans.jobs import JobResult
from conceptmill.sources.keyed import KeyedTable
from conceptmill.sources.tables import materialised, read_table_or_empty

ANNOTATION_SCHEMA = (
    "ann_uri string, task_uri string, target string, body string, motivated_by string, "
    "agent_uri string, agent_type string, g string"
)
CONTAINER_SCHEMA = "container_uri string, uuid string, resource string"
FAILED_SCHEMA = "decision string, text string, error string, tries int, due timestamp"


def of_scheme(codelist: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Annotations that count as done for a codelist: with one of its concepts, or with no match."""
    concepts = codelist.select(F.col("uri").alias("body")).distinct()

    def done(annotations: DataFrame) -> DataFrame:
        none = annotations.where(F.col("body") == v.NO_MATCH)
        return annotations.join(concepts, "body", "left_semi").select(*none.columns).unionByName(none)

    return done


def annotation_table(path: str) -> KeyedTable:
    """Annotations at the path, indexed by target."""
    return KeyedTable(path, ANNOTATION_SCHEMA, ANNOTATION_KEY, ["target"])


def append_annotations(annotations: DataFrame, path: str) -> None:
    """Append annotations that are not in the table yet."""
    annotation_table(path).append(annotations)


def append_containers(containers: DataFrame, path: str) -> None:
    KeyedTable(path, CONTAINER_SCHEMA, ["container_uri"], ["container_uri"]).append(containers)


@dataclass(frozen=True)
class LabelledTables:
    """Where labelled decisions go: annotations, containers, and decisions without a usable reply.

    Failed decisions are rows with the number of tries and the time from which they may be asked
    again, in a folder for each batch; a batch carries on what still waits.
    """

    annotations: str
    containers: str
    failed: str
    done: Callable[[DataFrame], DataFrame] | None = None
    retry_seconds: float = 0.0

    def _waiting(self, spark: SparkSession, number: int) -> DataFrame:
        return read_table_or_empty(spark, f"{self.failed}/batch-{number}", FAILED_SCHEMA)

    def label(self, arrived: DataFrame, label: Callable[[DataFrame], JobResult], number: int, since: int) -> None:
        """Label what has arrived, and what waits in the folder of batch ``since`` and is due, as batch ``number``."""
        spark = arrived.sparkSession
        waiting = materialised(self._waiting(spark, since).withColumn("is_due", F.col("due") <= F.current_timestamp()), "waiting")
        both = arrived.select("decision", "text", F.lit(0).alias("tries")).unionByName(
            waiting.where("is_due").select("decision", "text", "tries")
        )
        asked = materialised(both.groupBy("decision").agg(F.min("text").alias("text"), F.max("tries").alias("tries")), "arrived")
        known = annotation_table(self.annotations).held(asked.select(F.col("decision").alias("target")))
        # Only ids are written, before the table changes; the texts stay in ``asked``.
        finished = materialised(
            (self.done(known) if self.done else known).select(F.col("target").alias("decision")).distinct(), "finished"
        )
        result = label(asked.join(finished, "decision", "left_anti").select("decision", "text"))
        append_containers(result.containers, self.containers)
        append_annotations(result.annotations, self.annotations)
        later = waiting.where("NOT is_due").drop("is_due").join(asked, "decision", "left_anti")
        if result.failed is not None:
            errors = result.failed.select(
                F.col("id").alias("decision"), F.coalesce("call_error", "parse_error").alias("error")
            ).join(finished, "decision", "left_anti")
            pause = F.lit(self.retry_seconds) * F.pow(F.lit(2.0), F.col("tries"))
            due = F.timestamp_micros(F.unix_micros(F.current_timestamp()) + (pause * 1_000_000).cast("bigint"))
            again = asked.join(errors, "decision").withColumn("due", due).withColumn("tries", F.col("tries") + 1)
            later = later.unionByName(again.select(*later.columns))
        later.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.failed}/batch-{number}")

    def retry(self, spark: SparkSession, label: Callable[[DataFrame], JobResult]) -> int:
        """Ask again what is due, without waiting for an arrival; for a timer, while no stream runs. What still waits is returned."""
        files = read_table_or_empty(spark, f"{self.failed}/batch-*", FAILED_SCHEMA).inputFiles()
        if not files:
            return 0
        last = max(int(re.search(r"/batch-(\d+)/", file).group(1)) for file in files)
        self.label(spark.createDataFrame([], "decision string, text string"), label, last, last)
        return self._waiting(spark, last).count()


def label_stream(
    arriving: DataFrame,
    label: Callable[[DataFrame], JobResult],
    *,
    annotations_path: str,
    containers_path: str,
    checkpoint: str,
    failed_path: str | None = None,
    done: Callable[[DataFrame], DataFrame] | None = None,
    retry_seconds: float = 0.0,
) -> StreamingQuery:
    """Label each arriving decision once.

    ``label`` turns a batch of (decision, text) into a JobResult. Decisions that
    the annotation table already targets are left out; ``done`` narrows which
    annotations (their keys) count (see ``of_scheme``). What is done lives in the table, not in stream
    state, so the state does not grow; a batch reads the buckets of the table's index that it touches.
    Containers are written before annotations: a batch that is repeated after a failure then finds its
    decisions still open, and ids derived from the content keep the repetition from adding rows.

    A decision that comes twice in a batch is labelled once. Decisions without a usable
    reply are kept at ``failed_path`` (default: beside the annotations) and asked again with
    the first batch after ``retry_seconds``, then after twice that time and so on;
    ``LabelledTables.retry`` asks them without an arrival.
    """
    tables = LabelledTables(
        annotations_path, containers_path, failed_path or f"{annotations_path.rstrip('/')}-failed", done, retry_seconds
    )
    return (
        arriving.writeStream.foreachBatch(lambda batch, number: tables.label(batch, label, number, number - 1))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def annotation_stream(
    arriving: DataFrame, *, annotations_path: str, checkpoint: str, event_time: str | None = None, delay: str = "1 hour"
) -> StreamingQuery:
    """Store a stream of annotation rows without duplicates.

    The table's index knows what is stored, so the stream keeps no state. With an event time
    repetitions within the delay are dropped before they reach the table; that state forgets older keys.
    """
    if event_time:
        arriving = arriving.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(ANNOTATION_KEY))
    names = [part.split()[0] for part in ANNOTATION_SCHEMA.split(", ")]
    return (
        arriving.select(*names)
        .writeStream.foreachBatch(lambda batch, _: append_annotations(batch, annotations_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
