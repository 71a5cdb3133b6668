"""Prompt settings from a JSON configuration file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "codelist_prompts map<string, struct<system_message: string, user_message: string>>"


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """(scheme, system_message, user_message) from the ``codelist_prompts`` of the file."""
    config = spark.read.schema(_SCHEMA).option("multiLine", True).json(path)
    return config.select(F.explode("codelist_prompts").alias("scheme", "prompt")).select("scheme", "prompt.*")
