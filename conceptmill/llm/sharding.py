"""Operator 6. Reproducible shuffle: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptmill.operators.skew import hash_rank

SHARDS = 16
ROUNDS = 6
PRIME = (1 << 31) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """A multiplier and an offset below the prime for each round, from the seed alone."""
    keys, state = [], seed % PRIME
    for _ in range(rounds):
        state = (state * 48271 + 11) % PRIME
        first = state or 1
        state = (state * 48271 + 11) % PRIME
        keys.append((first, state))
    return keys


def domain(n: int) -> tuple[int, int]:
    """The two radices a, b with a * b >= n and a * b - n < a."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, -(-max(n, 1) // a)


def permuted(position: np.ndarray, n: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """Image of each position under a permutation of 0..n-1.

    A position is split into (left, right) with radices a and b, the rounds add a keyed
    function of one half to the other, and images outside 0..n-1 are permuted again until
    they fall inside. Fewer than a numbers lie outside, so the walk ends.
    """
    a, b = domain(n)
    keys = round_keys(seed, rounds)

    def mixed(x: np.ndarray, key: tuple[int, int]) -> np.ndarray:
        x = (x * key[0] + key[1]) % PRIME
        x = x * x % PRIME
        return (x * key[1] + key[0]) % PRIME

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x // b, x % b
        for i, key in enumerate(keys):
            if i % 2:
                right = (right + mixed(left, key)) % b
            else:
                left = (left + mixed(right, key)) % a
        return left * b + right

    image = once(np.asarray(position, dtype=np.int64))
    outside = np.flatnonzero(image >= n)
    while outside.size:
        image[outside] = once(image[outside])
        outside = outside[image[outside] >= n]
    return image


def identity(docs: DataFrame) -> Column:
    """Text that tells rows apart: the id (marked when null), checksum and size of the text."""
    text = F.coalesce("text", F.lit(""))
    return F.concat_ws(
        ":",
        F.coalesce(docs["doc_id"].cast("string"), F.lit("null")),
        F.crc32(text.cast("binary")).cast("string"),
        F.octet_length(text).cast("string"),
        F.isnull("text").cast("string"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = 42) -> DataFrame:
    """All rows and columns of ``docs`` with size, text_crc32, shard and slot.

    Rows are numbered in the order of the md5 of their identity, so the number does not
    depend on files or partitions; ranges of the md5 are counted and numbered apart. The
    permuted number p gives shard p mod ``shards`` and slot p div ``shards``: counts per
    shard differ by one at most and slots have no gaps. Given n and the seed, a row's place
    follows from its number alone.

    A null text has size 1 and the checksum of no bytes. Rows that repeat id and text get
    numbers of their own; which copy gets which does not matter, as they are equal.
    Columns named size, text_crc32, shard or slot are replaced. An empty table gives none.
    """
    n = docs.select(F.lit(1)).count()
    text = F.coalesce("text", F.lit(""))
    kept = [c for c in docs.columns if c not in ("size", "text_crc32", "shard", "slot")]
    # Columns under plain numbers, so that their names meet no others.
    measured = docs.select(
        *(docs[c].alias(f"c{i}") for i, c in enumerate(kept)),
        identity(docs).alias("uid"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # Measured before rows move, so texts move only where they are asked for.
    numbered = hash_rank(measured, "uid", name="number")

    @F.pandas_udf("bigint")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permuted(number.to_numpy() - 1, n, seed))

    placed = numbered.withColumn("place", place("number"))
    shard = (F.col("place") % shards).cast("int").alias("shard")
    slot = F.floor(F.col("place") / shards).cast("bigint").alias("slot")
    own = (F.col(f"c{i}").alias(c) for i, c in enumerate(kept))
    return placed.select(*own, "size", "text_crc32", shard, slot)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Parquet folders shard=0.. with the rows of each in the order of their slots."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
