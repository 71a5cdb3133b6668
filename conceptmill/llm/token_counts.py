"""Operator 7. Exact histogram of encoded lengths and what follows from it by suffix sums."""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pattern that cuts a text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 1024


def _encoder(ranks: bytes) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines())
    merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def encoded_lengths(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(n_tokens, n_docs) of every partition: documents by the length of their encoded text.

    The rank file (under 1 MB, a fixed vocabulary) is read once by the driver and sent
    to the tasks, so executors need no copy of it.
    """
    with open(tokenizer, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks.value).encode_ordinary
        seen: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[len(encode(text)) if text else 0] += 1
        yield pa.RecordBatch.from_pydict(
            {"n_tokens": pa.array(seen.keys(), pa.int64()), "n_docs": pa.array(seen.values(), pa.int64())}
        )

    return docs.select("text").mapInArrow(count, "n_tokens bigint, n_docs bigint")


def length_histogram(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per encoded length that occurs, with its suffix sums.

    n_tokens         the length
    n_docs           documents of just this length
    docs_from        documents at least as long
    tokens_from      tokens of the documents at least as long
    docs_total, tokens_total   of all documents
    truncated_total  tokens left when every text is cut to this length
    share_within     share of the documents that are no longer than this, i.e. the
                     quantile at which this length stands

    Null and empty texts have length 0; repeated rows count each time; an empty table
    gives no rows. Each partition sends one row per length it holds. The suffix sums run
    over lengths, first by blocks of 1024 lengths and then inside a block.
    """
    lengths = encoded_lengths(docs, tokenizer).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    lengths = lengths.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK)).withColumn(
        "_tokens", F.col("n_tokens") * F.col("n_docs")
    )
    behind = Window.partitionBy(F.lit(0)).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    blocks = (
        lengths.groupBy("_block")
        .agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
        .select(
            "_block",
            F.coalesce(F.sum("_d").over(behind), F.lit(0)).alias("_docs_behind"),
            F.coalesce(F.sum("_t").over(behind), F.lit(0)).alias("_tokens_behind"),
            F.sum("_d").over(everything).alias("docs_total"),
            F.sum("_t").over(everything).alias("tokens_total"),
        )
    )
    inside = Window.partitionBy("_block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    summed = lengths.withColumn("_docs", F.sum("n_docs").over(inside)).withColumn(
        "_in_block", F.sum("_tokens").over(inside)
    )
    return (
        summed.join(blocks, "_block")
        .withColumn("docs_from", F.col("_docs") + F.col("_docs_behind"))
        .withColumn("tokens_from", F.col("_in_block") + F.col("_tokens_behind"))
        .select(
            "n_tokens",
            "n_docs",
            "docs_from",
            "tokens_from",
            "docs_total",
            "tokens_total",
            (F.col("tokens_total") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias(
                "truncated_total"
            ),
            ((F.col("docs_total") - F.col("docs_from") + F.col("n_docs")) / F.col("docs_total")).alias("share_within"),
        )
    )


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, total, n_cut): tokens and cut documents when texts are cut to each limit."""
    spark: SparkSession = histogram.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in sorted(set(limits))], "context_limit bigint")
    cut = F.col("n_tokens") > F.col("context_limit")
    return (
        histogram.crossJoin(F.broadcast(asked))  # a stated, short list of limits
        .groupBy("context_limit")
        .agg(
            F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("total"),
            F.sum(F.when(cut, F.col("n_docs")).otherwise(0)).alias("n_cut"),
        )
    )


def length_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the smallest length within which at least that share of documents lies."""
    return histogram.agg(
        *(F.min(F.when(F.col("share_within") >= s, F.col("n_tokens"))).alias(f"_{i}") for i, s in enumerate(shares))
    ).select(
        F.explode(
            F.array(*(F.struct(F.lit(float(s)).alias("share"), F.col(f"_{i}").alias("n_tokens")) for i, s in enumerate(shares)))
        ).alias("q")
    ).select("q.share", "q.n_tokens")
