"""Tables between steps, and tables that may not be there yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from conceptmill.session import scratch_path


def table_exists(spark: SparkSession, path: str) -> bool:
    return _read(spark, path, "none string") is not None


def _read(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_table_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table at the path, or no rows if nothing has been written there yet."""
    found = _read(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def materialised(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    Later steps and retried tasks then reuse what is written, which matters for
    replies of a paid model, and the planner knows the real size.
    """
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
