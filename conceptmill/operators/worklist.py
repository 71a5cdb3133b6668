"""What is open for a codelist, kept up to date from quads that are added and removed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.operators.selection import scheme_concepts
from conceptmill.operators.skew import all_of, spread_join
from conceptmill.sources.tables import materialised, read_table_or_empty

TYPED, MOTIVE, BODY, TARGET = range(4)
MARKS = "g string, ann string, mark int, value string, n bigint"
COUNTS = "decision string, kind string, n bigint"


@dataclass(frozen=True)
class Worklist:
    """Open decisions of ``scheme`` under ``path``: as ``selection.unannotated_decisions`` has them.

    Two tables, each in ``n_buckets`` folders by hash: the quads that make an annotation count
    (by annotation), and for each decision how often it is typed as an expression and how many
    annotations for the scheme target it. An update works on the annotations it touches: it reads
    and rewrites their buckets and adds what has changed to the counts of their targets, so the
    store is never aggregated again. Rows that have come to nothing stay as zeros until ``rebuild``.

    The quads of an annotation may come and go in any order and in different updates. The codelist is
    taken at ``rebuild``; an update that changes it is an error. An update that was stopped
    half-way leaves the list unsettled, and the next one asks for ``rebuild``. One writer at a time.
    """

    path: str
    scheme: str
    target_graph: str | None = None
    ai_graph: str | None = None
    n_buckets: int = 256

    @property
    def _graphs(self) -> list[str]:
        return sorted({self.ai_graph or v.GRAPHS["ai"], *([self.target_graph] if self.target_graph else [])})

    def _marks(self, quads: DataFrame) -> DataFrame:
        """(g, ann, mark, value, n) of the quads (with n) that matter for annotations."""
        value, uri = F.col("o.value"), F.col("o.kind") == "uri"
        mark = (
            F.when((F.col("p") == v.TYPE) & (value == v.ANNOTATION) & uri, TYPED)
            .when((F.col("p") == v.MOTIVATED_BY) & (value == v.CLASSIFYING) & uri, MOTIVE)
            .when(F.col("p") == v.HAS_BODY, BODY)
            .when(F.col("p") == v.HAS_TARGET, TARGET)
        )
        found = quads.where(F.col("g").isin(self._graphs)).select("g", F.col("s").alias("ann"), mark.alias("mark"), value.alias("value"), "n")
        return found.where("mark IS NOT NULL").groupBy("g", "ann", "mark", "value").agg(F.sum("n").alias("n"))

    def _typed(self, quads: DataFrame) -> DataFrame:
        typed = quads.where((F.col("p") == v.TYPE) & (F.col("o.value") == v.EXPRESSION) & (F.col("o.kind") == "uri"))
        if self.target_graph:
            typed = typed.where(F.col("g") == self.target_graph)
        return typed.select(F.col("s").alias("decision"), F.lit("typed").alias("kind"), "n")

    def _done(self, marks: DataFrame, concepts: DataFrame, sign: int) -> DataFrame:
        """(decision, 'done', sign) for each annotation that counts, and each of its targets."""
        there = marks.where("n > 0")
        bodies = there.where(F.col("mark") == BODY)
        known = spread_join(bodies, concepts, ["g", "value"], "left_semi", spread=["ann"])
        parts = there.where(F.col("mark").isin(TYPED, MOTIVE)).unionByName(known)
        full = all_of(parts, ["g", "ann"], [F.col("mark") == i for i in (TYPED, MOTIVE, BODY)])
        targets = there.where(F.col("mark") == TARGET).join(full, ["g", "ann"], "left_semi")
        return targets.select(F.col("value").alias("decision"), F.lit("done").alias("kind"), F.lit(sign).cast("bigint").alias("n"))

    def _bucket(self, *columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.n_buckets)).cast("int")

    def _read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        return read_table_or_empty(spark, f"{self.path}/{table}", f"{schema}, bucket int")

    def _near(self, table: str, schema: str, changes: DataFrame, *by: str) -> DataFrame:
        """Rows of the buckets that ``changes`` fall into."""
        touched = [r[0] for r in changes.select(self._bucket(*by)).distinct().collect()]  # n_buckets at most
        return self._read(changes.sparkSession, table, schema).where(F.col("bucket").isin(touched)).drop("bucket")

    def _write(self, rows: DataFrame, table: str, *by: str, mode: str = "dynamic") -> None:
        placed = rows.withColumn("bucket", self._bucket(*by)).repartition("bucket")
        placed.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("bucket").parquet(f"{self.path}/{table}")

    def _settled(self, spark: SparkSession, settled: bool) -> None:
        spark.createDataFrame([(settled,)], "settled boolean").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state")

    def rebuild(self, quads: DataFrame) -> None:
        """Make the list from all quads."""
        spark, one = quads.sparkSession, quads.withColumn("n", F.lit(1).cast("bigint"))
        self._settled(spark, False)
        concepts = scheme_concepts(quads.where(F.col("g").isin(self._graphs)), self.scheme)
        concepts.select("g", F.col("concept").alias("value")).distinct().write.mode("overwrite").parquet(f"{self.path}/concepts")
        self._write(self._marks(one), "marks", "g", "ann", mode="static")
        done = self._done(self._read(spark, "marks", MARKS), self._concepts(spark), 1)
        counts = self._typed(one).unionByName(done).groupBy("decision", "kind").agg(F.sum("n").alias("n"))
        self._write(counts, "counts", "decision", mode="static")
        self._settled(spark, True)

    def _concepts(self, spark: SparkSession) -> DataFrame:
        return read_table_or_empty(spark, f"{self.path}/concepts", "g string, value string")

    def update(self, added: DataFrame, removed: DataFrame) -> None:
        """Take in quads that the store did not have, and quads that it no longer has."""
        spark = added.sparkSession
        state = read_table_or_empty(spark, f"{self.path}/state", "settled boolean").first()
        if state is None or not state["settled"]:
            raise RuntimeError(f"the worklist at {self.path} has to be rebuilt")
        delta = materialised(
            added.select("g", "s", "p", "o", F.lit(1).cast("bigint").alias("n")).unionByName(
                removed.select("g", "s", "p", "o", F.lit(-1).cast("bigint").alias("n"))
            ),
            "worklist-delta",
        )
        if not scheme_concepts(delta.where(F.col("g").isin(self._graphs)), self.scheme).isEmpty():
            raise ValueError("the codelist has changed: rebuild the worklist")
        changes, concepts = materialised(self._marks(delta), "worklist-changes"), self._concepts(spark)
        keys = changes.select("g", "ann").distinct()
        before = self._near("marks", MARKS, changes, "g", "ann")
        after = materialised(
            before.unionByName(changes).groupBy("g", "ann", "mark", "value").agg(F.sum("n").alias("n")), "worklist-marks"
        )
        own = (rows.join(keys, ["g", "ann"], "left_semi") for rows in (after, before))
        moved = self._done(next(own), concepts, 1).unionByName(self._done(next(own), concepts, -1))
        steps = self._typed(delta).unionByName(moved).groupBy("decision", "kind").agg(F.sum("n").alias("n"))
        steps = materialised(steps.where("n <> 0"), "worklist-steps")
        near = self._near("counts", COUNTS, steps, "decision")
        counts = materialised(near.unionByName(steps).groupBy("decision", "kind").agg(F.sum("n").alias("n")), "worklist-counts")
        self._settled(spark, False)
        self._write(after, "marks", "g", "ann")
        self._write(counts, "counts", "decision")
        self._settled(spark, True)

    def open_decisions(self, spark: SparkSession) -> DataFrame:
        """``decision`` of all that are typed and have no annotation for the scheme."""
        n = F.col("n")
        per_decision = self._read(spark, "counts", COUNTS).groupBy("decision").agg(
            F.sum(F.when(F.col("kind") == "typed", n).otherwise(0)).alias("typed"),
            F.sum(F.when(F.col("kind") == "done", n).otherwise(0)).alias("done"),
        )
        return per_decision.where("typed > 0 AND done = 0").select("decision")
