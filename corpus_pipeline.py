"""Training-data pipeline: five stages over documents, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. Stages but
the last return the columns of documents. Which operator decides what:

quality rules        drops documents that the rules reject
n-gram Jaccard join  keeps one row of each group of near copies, that with the smallest doc_id (5-word
                     shingles, Jaccard 0.8; op5_ngram_join links by its own rule of 3 words and 0.9)
decontamination      drops documents that hold a passage of the benchmark
mixing               takes words of each source up to its target; a document may be taken in
                     part, once or twice, and then stands as one row for each pass
sharding             puts every row into a shard and a slot

A null text has no words. Rows with null or repeated ids, and equal rows, go through every stage as rows of
their own; other columns stay as they are, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from conceptmill.llm import decontamination, mixing, ngram_join, quality_rules, sharding
from conceptmill.llm.common import table
from conceptmill.session import scratch_path

# Documents are near copies when their sets of so many words in a row are alike to this percentage.
NEAR_COPY_WORDS, NEAR_COPY_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has too few or too often repeated words, or too little of the trusted texts, go; null and empty texts with them."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies or equal rows stays (null ids last); rows without words all stay."""
    return ngram_join.first_of_each(docs, n=NEAR_COPY_WORDS, percent=NEAR_COPY_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a benchmark passage go, whatever their id; rows without text stay."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each pass that takes words of a row, with these words; rows without words are not taken. A null source is one of its own."""
    return mixing.mixed_texts(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with size, text_crc32, shard and slot; columns of these names are replaced."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_join", near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# The stages hash, draw and iterate in ways that SQL does not state; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
