"""Journal of model calls: requests in folders by chunk, replies with a marker for each chunk that is whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptmill.sources.tables import read_table_or_empty

PLACE = "run string, round int, chunk int"
FAILED = "call_error IS NOT NULL OR parse_error IS NOT NULL"


class ReplyJournal:
    """What was asked and answered under ``path``, by runs, rounds and chunks.

    ``requests/run=/round=/chunk=`` is written once for a round, so each chunk is read from its
    own folder. ``replies/run=/round=/chunk=`` counts only with its marker in ``done``, which is
    written after it: a chunk that was cut off is asked again and replaces what it left.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str, run: str | None = None) -> None:
        self.spark, self.path, self.run = spark, path.rstrip("/"), run or uuid.uuid4().hex
        self.schema = f"id {id_type}, asked string, raw string, call_error string, parse_error string, sent double"

    def _folder(self, kind: str, round_: int) -> str:
        return f"{self.path}/{kind}/run={self.run}/round={round_}"

    def requests(self, rows: DataFrame, round_: int) -> None:
        """Write the requests of a round by their column ``chunk``, each from several tasks."""
        rows.repartition("chunk", F.pmod(F.xxhash64("id"), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "chunk"
        ).parquet(self._folder("requests", round_))

    def chunk(self, schema: str, round_: int, chunk: int) -> DataFrame:
        """The requests of one chunk, from its folder alone."""
        return read_table_or_empty(self.spark, f"{self._folder('requests', round_)}/chunk={chunk}", schema)

    def committed(self) -> DataFrame:
        return read_table_or_empty(self.spark, f"{self.path}/done", PLACE).distinct()

    def commit(self, replies: DataFrame, round_: int, chunk: int) -> None:
        """Write the replies of a chunk, then its marker."""
        names = [f.split()[0] for f in self.schema.split(", ")]
        folder = f"{self._folder('replies', round_)}/chunk={chunk}"
        replies.select(*names).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
        marker = self.spark.createDataFrame([(self.run, round_, chunk)], PLACE).coalesce(1)
        marker.write.mode("append").parquet(f"{self.path}/done")

    def replies(self) -> DataFrame:
        """Replies of all whole chunks of all runs, in one read."""
        rows = read_table_or_empty(self.spark, f"{self.path}/replies", f"{self.schema}, {PLACE}")
        return rows.join(self.committed(), ["run", "round", "chunk"], "left_semi")

    def own(self, round_: int | None = None) -> DataFrame:
        """Replies of this run, or of one of its rounds."""
        rows = self.replies().where(F.col("run") == self.run)
        return rows if round_ is None else rows.where(F.col("round") == round_)

    def usable(self) -> DataFrame:
        """(id, asked, raw): one usable reply for each id and message, of any run."""
        return self.replies().where(f"NOT ({FAILED})").groupBy("id", "asked").agg(F.min("raw").alias("raw"))
