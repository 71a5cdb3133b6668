"""Query results in the SPARQL JSON results format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CELL = T.StructType([T.StructField(name, T.StringType()) for name in ("type", "value", "xml:lang", "datatype")])


def _schema(variables: Sequence[str]) -> T.StructType:
    binding = T.StructType([T.StructField(name, _CELL) for name in variables])
    results = T.StructType([T.StructField("bindings", T.ArrayType(binding))])
    return T.StructType([T.StructField("results", results)])


def read_results(spark: SparkSession, path: str, variables: Sequence[str], *, one_per_line: bool = False) -> DataFrame:
    """A column of text per variable and a row per solution; unbound is NULL.

    Each file holds one result document, or one document per line. The schema
    is fixed by the variables, so nothing is read twice to infer it.
    """
    reader = spark.read.schema(_schema(variables))
    documents = reader.json(path) if one_per_line else reader.option("multiLine", True).json(path)
    rows = documents.select(F.explode("results.bindings").alias("b"))
    return rows.select(*[F.col(f"b.{name}.value").alias(name) for name in variables])


def results_documents(solutions: DataFrame, page: str) -> DataFrame:
    """One result document per value of ``page`` from text columns.

    A page is meant to hold a bounded number of solutions.
    """
    names = [name for name in solutions.columns if name != page]
    cells = [
        F.when(F.col(n).isNotNull(), F.struct(F.lit("literal").alias("type"), F.col(n).alias("value"))).alias(n)
        for n in names
    ]
    paged = solutions.groupBy(page).agg(F.collect_list(F.struct(*cells)).alias("bindings"))
    head = F.struct(F.array(*[F.lit(n) for n in names]).alias("vars")).alias("head")
    return paged.select(F.to_json(F.struct(head, F.struct("bindings").alias("results"))).alias("value"))
