"""Pieces that several operators share: words, hashes, tables, sums of counters."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptmill.session import scratch_path

# A word is a run of characters other than these six; ``bytes.split`` splits at the same ones.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
WORD = rf"[^{SPACE_CLASS}]+"

# Words one worker remembers ids for; the memory is emptied between documents when it is full.
REMEMBERED_WORDS = 400_000
# Rows of an Arrow batch that hold whole texts or sets.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null gives no bytes."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most BATCH_ROWS rows in what runs inside, then as the session had it.

    A batch stands in the JVM and in a Python worker, and its texts again as Python values.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    if before is None or not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most BATCH_ROWS rows; for results whose run the caller starts."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(start, BATCH_ROWS)


class WordHashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, found: Sequence[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def in_chunks(texts: Iterable[bytes], size: int = 1 << 20) -> Iterator[slice]:
    """Slices of consecutive texts of about ``size`` bytes; a longer text stands alone."""
    start = held = 0
    at = -1
    for at, text in enumerate(texts):
        if held and held + len(text) > size:
            yield slice(start, at)
            start, held = at, 0
        held += len(text) + 1
    if at >= start:
        yield slice(start, at + 1)


def columns(rows: DataFrame) -> dict[str, np.ndarray]:
    """Columns of a small result on the driver."""
    table = rows.toArrow()
    return {name: table.column(name).to_numpy() for name in table.column_names}


def hash_sample(ids: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` of the distinct values of one column, those with the smallest hash.

    A cut on the hash leaves a little more than ``limit`` rows before they are sorted.
    """
    n, of = ids.count(), F.pmod(F.xxhash64(*ids.columns), F.lit(1 << 40))
    if n > limit:
        ids = ids.where(of <= int((limit + 4 * limit**0.5) / n * (1 << 40)) + 1)
    return ids.orderBy(of, *ids.columns).limit(limit)


def counters(parts: DataFrame, key: str, *values: str) -> dict[str, np.ndarray]:
    """Sums of ``values`` by ``key`` on the driver.

    Only for keys out of a fixed, documented range (buckets, letters, states).
    """
    return columns(parts.groupBy(key).agg(*(F.sum(v).alias(v) for v in values)))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bit_filter(values: DataFrame, bits: int) -> np.ndarray:
    """Bits set at two places of every value of the one column, a 64-bit hash.

    64 bits a row, so at most 2^(bits - 6) rows reach the driver, whatever the input.
    """
    low, name = (1 << bits) - 1, values.columns[0]
    places = F.array(F.col(name).bitwiseAND(low), F.shiftrightunsigned(name, bits).bitwiseAND(low))
    rows = (
        values.select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", 6).cast("int").alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS INT))")).alias("bits"))
    )
    found, packed = columns(rows), np.zeros(1 << (bits - 6), np.int64)
    packed[found["at"]] = found["bits"]
    return packed.view(np.uint64)


def may_hold(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the unsigned values may be in the filter; false only for those that are not."""
    bits = (packed.size * 64).bit_length() - 1
    low = np.uint64((1 << bits) - 1)

    def held(place: np.ndarray) -> np.ndarray:
        at = (place >> np.uint64(6)).astype(np.int64)
        return (packed[at] >> (place & np.uint64(63))) & np.uint64(1) > 0

    return held(values & low) & held((values >> np.uint64(bits)) & low)
