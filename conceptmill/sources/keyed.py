"""Stored tables that take a row once: an index beside the table says what it holds.

The index has the keys of all rows (or their digests, where keys are long) in folders by hash,
``<path>-index/of-<n>/bucket=<k>``, each sorted, with one file. An append reads and rewrites the
buckets its keys fall into and never reads the table. When buckets have grown to twice their
size there are four times as many, so a bucket never holds more than a fixed number of keys.

A mark, ``<path>-index/state``, is unset before the table is written and set again when the
index has followed. An append that finds it unset, after a failure in between or where there is
no index yet, first makes the index anew from the table. One writer at a time; whoever changes
the table by other means calls ``rebuild``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conceptmill.operators.writes import only_new
from conceptmill.sources.tables import materialised, read_table_or_empty, table_exists

STATE = "n_buckets int, n_rows bigint, settled boolean"
LEAST_BUCKETS = 16
# New rows that one task compares, about.
TASK_ROWS = 250_000


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` whose rows differ in ``keys``; ``by`` (part of keys) decides the bucket.

    ``hashed``: the index holds a 128-bit digest of the keys instead of the keys.
    """

    path: str
    schema: str | StructType
    keys: Sequence[str]
    by: Sequence[str]
    partition_by: Sequence[str] = field(default=())
    hashed: bool = False
    rows_per_bucket: int = 1_000_000

    @property
    def _index(self) -> str:
        return f"{self.path.rstrip('/')}-index"

    @property
    def _entry(self) -> list[str]:
        return ["_entry"] if self.hashed else list(self.keys)

    def _with_entry(self, rows: DataFrame) -> DataFrame:
        if not self.hashed:
            return rows
        digest = F.sha2(F.to_json(F.struct(*self.keys)), 256)
        return rows.withColumn("_entry", F.unhex(F.substring(digest, 1, 32)))

    def _bucket(self, n_buckets: int) -> Column:
        return F.pmod(F.xxhash64(*(self._entry if self.hashed else self.by)), F.lit(n_buckets)).cast("int")

    def _read(self, spark: SparkSession, n_buckets: int) -> DataFrame:
        rows = self._with_entry(spark.createDataFrame([], self.schema)).select(*self._entry)
        types = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "bucket int"]
        return read_table_or_empty(spark, f"{self._index}/of-{n_buckets}", ", ".join(types))

    def _write(self, entries: DataFrame, n_buckets: int) -> None:
        """Replace the buckets that ``entries`` has rows of."""
        placed = entries.select(*self._entry, self._bucket(n_buckets).alias("bucket"))
        (
            placed.repartition("bucket")
            .sortWithinPartitions("bucket", *self._entry)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(f"{self._index}/of-{n_buckets}")
        )

    def _mark(self, spark: SparkSession, n_buckets: int, n_rows: int, settled: bool) -> Row:
        state = Row(n_buckets=n_buckets, n_rows=n_rows, settled=settled)
        spark.createDataFrame([state], STATE).coalesce(1).write.mode("overwrite").parquet(f"{self._index}/state")
        return state

    def _fitting(self, n_rows: int) -> int:
        n_buckets = LEAST_BUCKETS
        while n_buckets * self.rows_per_bucket < n_rows:
            n_buckets *= 4
        return n_buckets

    def rebuild(self, spark: SparkSession) -> Row:
        """Make the index from the table."""
        entries = self._with_entry(read_table_or_empty(spark, self.path, self.schema)).select(*self._entry).distinct()
        n_rows = entries.count()
        n_buckets = self._fitting(n_rows)
        self._mark(spark, n_buckets, 0, False)
        # All buckets, so that none stays from an index that did not follow its table.
        entries.select(*self._entry, self._bucket(n_buckets).alias("bucket")).repartition("bucket").sortWithinPartitions(
            "bucket", *self._entry
        ).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(
            f"{self._index}/of-{n_buckets}"
        )
        return self._mark(spark, n_buckets, n_rows, True)

    def _state(self, spark: SparkSession) -> Row:
        state, there = read_table_or_empty(spark, f"{self._index}/state", STATE).first(), table_exists(spark, self.path)
        if state is None and not there:
            return Row(n_buckets=LEAST_BUCKETS, n_rows=0, settled=True)
        # An index without its table is what a deleted table has left.
        return state if there and state is not None and state["settled"] else self.rebuild(spark)

    def _near(self, rows: DataFrame, state: Row) -> DataFrame:
        """Entries in the buckets that ``rows`` fall into."""
        n_buckets = state["n_buckets"]
        touched = [r[0] for r in rows.select(self._bucket(n_buckets)).distinct().limit(n_buckets // 2 + 1).collect()]
        entries = self._read(rows.sparkSession, n_buckets)
        # Of more than half of the buckets all are read: a list of folders would not spare much.
        return entries if len(touched) > n_buckets // 2 else entries.where(F.col("bucket").isin(touched))

    def held(self, wanted: DataFrame) -> DataFrame:
        """The keys in the table whose ``by`` columns are among those of ``wanted``, from the buckets touched only."""
        if self.hashed:
            raise ValueError("the index of this table holds digests")
        single = wanted.select(*self.by).distinct()
        entries = self._near(single, self._state(wanted.sparkSession)).select(*self.keys)
        return entries.join(single, list(self.by), "left_semi").select(*self.keys)

    def append(self, new: DataFrame) -> None:
        """Add the rows whose keys the table lacks; of several new rows with one key the smallest."""
        spark = new.sparkSession
        columns = spark.createDataFrame([], self.schema).columns
        state = self._state(spark)
        # Written, as it is used several times and must not change once the table has it.
        rows = materialised(self._with_entry(new.select(*columns)), "keyed-new")
        entries = self._near(rows, state)
        # Dealt by key before equal rows meet, so that no task sorts or holds more than its share of new rows.
        dealt = rows.repartition(max(1, -(-rows.count() // TASK_ROWS)), *self._entry).distinct()
        fresh = materialised(only_new(dealt, entries, self._entry), "keyed-fresh")
        n_fresh = fresh.count()
        if not n_fresh:
            return
        self._mark(spark, state["n_buckets"], state["n_rows"], False)
        data = fresh.select(*columns)
        if self.partition_by:
            data = data.hint("rebalance", *self.partition_by)
        data.write.mode("append").partitionBy(*self.partition_by).parquet(self.path)
        n_rows = state["n_rows"] + n_fresh
        n_buckets = state["n_buckets"]
        if n_rows > 2 * n_buckets * self.rows_per_bucket:
            entries, n_buckets = self._read(spark, n_buckets), self._fitting(n_rows)
        self._write(entries.select(*self._entry).unionByName(fresh.select(*self._entry)), n_buckets)
        self._mark(spark, n_buckets, n_rows, True)
