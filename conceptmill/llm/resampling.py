"""Operator 13. Importance resampling towards a target: hashed word runs counted by an Aho-Corasick dictionary.

The dictionary holds distinct words between delimiters; each carries the CRC and the length of
its bytes. Scanning a text emits the payloads of its words in order; the CRC of a run of
words is composed of the payloads of its parts, so no run is ever cut out of a text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from conceptmill.llm.common import counters, in_chunks, raw_texts, written
from conceptmill.operators.skew import with_ordinal

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
DRAW_PERCENT = 10
# Longest run of words that is a feature.
RUN_WORDS = 1
# Words and bytes of one worker's dictionary; it starts anew when it is full.
DICTIONARY_WORDS, DICTIONARY_BYTES = 100_000, 1 << 20
# If a quarter of a chunk's words are new, they are added to it; fewer are measured on their own.
NEW_SHARE = 4

# A-Z become a-z; ASCII that is neither letter nor digit becomes the delimiter.
FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
CRC_BITS = 0xEDB88320


def shifted_crc(length: int) -> np.ndarray:
    """4 tables of 256: what each byte of a CRC becomes when ``length`` zero bytes follow."""
    column = [1 << bit for bit in range(32)]
    power = [CRC_BITS, *column[:31]]  # one zero bit, as the image of each bit

    def times(matrix: list[int], vector: int) -> int:
        total, bit = 0, 0
        while vector:
            if vector & 1:
                total ^= matrix[bit]
            vector, bit = vector >> 1, bit + 1
        return total

    bits = 8 * length
    while bits:
        if bits & 1:
            column = [times(power, x) for x in column]
        power, bits = [times(power, x) for x in power], bits >> 1
    return np.array([[times(column, byte << (8 * at)) for byte in range(256)] for at in range(4)], np.uint32)


class Shifts(dict):
    """Tables of ``shifted_crc`` by length."""

    def __missing__(self, length: int) -> np.ndarray:
        table = self[length] = shifted_crc(length)
        return table

    def composed(self, left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """CRCs of concatenations: of parts with the CRCs ``left`` and ``right``, the right one so long."""
        result = np.empty_like(left)
        for length in np.unique(lengths):
            if length not in self and len(self) > 4096:
                self.clear()
            some, table = lengths == length, self[int(length)]
            x = left[some]
            result[some] = table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]
        return result ^ right


class Dictionary:
    """Automaton of distinct words between delimiters; the payload is a place in two arrays, CRC and length."""

    def __init__(self) -> None:
        self.automaton, self.size, self.held = ahocorasick.Automaton(ahocorasick.STORE_INTS), 0, 0
        self.crc, self.length = np.empty(1024, np.uint32), np.empty(1024, np.int64)

    def add(self, words: list[bytes]) -> None:
        """Add distinct words as far as they fit."""
        held = np.cumsum([len(w) for w in words])
        words = words[: min(DICTIONARY_WORDS, int(np.searchsorted(held, DICTIONARY_BYTES, side="right")))]
        if self.size + len(words) > DICTIONARY_WORDS or self.held + sum(map(len, words)) > DICTIONARY_BYTES:
            self.__init__()
        while self.size + len(words) > self.crc.size:
            self.crc, self.length = (np.concatenate([x, np.empty_like(x)]) for x in (self.crc, self.length))
        for word in words:
            if self.automaton.add_word(f" {word.decode('latin-1')} ", self.size):
                self.crc[self.size], self.length[self.size] = zlib.crc32(word), len(word)
                self.size, self.held = self.size + 1, self.held + len(word)
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end, CRC, length) of the words of a text whose words stand between single delimiters.

        Words that the dictionary lacks show as delimiters where no match ends; a few are
        measured on their own, many are added and the text is scanned again.
        """
        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        for last in (False, True):
            found = np.empty(0, np.int64)
            if self.size:
                found = np.fromiter(chain.from_iterable(self.automaton.iter(text.decode("latin-1"))), np.int64)
            places, payloads = found[::2], found[1::2]
            if places.size == ends.size - 1:
                return places, self.crc[payloads], self.length[payloads]
            missed = np.flatnonzero(~np.isin(ends[1:], places, assume_unique=True))
            new = [text[ends[i] + 1 : ends[i + 1]] for i in missed]
            if last or len(new) * NEW_SHARE <= ends.size:
                break
            self.add(sorted(set(new), key=len))
        crc, length = np.empty(ends.size - 1, np.uint32), np.empty(ends.size - 1, np.int64)
        known = np.ones(ends.size - 1, bool)
        known[missed] = False
        crc[known], length[known] = self.crc[payloads], self.length[payloads]
        crc[missed], length[missed] = [zlib.crc32(w) for w in new], [len(w) for w in new]
        return ends[1:], crc, length


def run_buckets(crc: np.ndarray, length: np.ndarray, shifts: Shifts, run: int, buckets: int) -> Iterator[np.ndarray]:
    """Buckets of all runs of 1, 2, .. ``run`` words, from the payloads of the words of one text."""
    yield crc % buckets
    space, whole = np.uint32(zlib.crc32(b" ")), crc
    for n in range(1, min(run, crc.size)):
        left = shifts.composed(whole[:-1], np.full(whole.size - 1, space), np.ones(whole.size - 1, np.int64))
        whole = shifts.composed(left, crc[n:], length[n:])
        yield whole % buckets


def feature_buckets(docs: DataFrame, run: int = RUN_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """The columns of ``docs`` but text, with n_words and the buckets of all features (4 bytes each)."""
    if not 1 <= buckets < 1 << 31:
        raise ValueError("buckets has to be a positive 32-bit number")
    at, names = docs.columns.index("text"), [*(c for c in docs.columns if c != "text"), "n_words", "buckets"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shifts = Dictionary(), Shifts()
        for batch in batches:
            texts = raw_texts(batch.column(at))
            for part in in_chunks(texts):
                n_words, found = [], []
                spaced = [b" ".join(t.translate(FOLDED).split()) for t in texts[part]]
                ends, crc, length = words.scan(b" " + b"".join(t + b" " for t in spaced if t))
                stops = np.cumsum([len(t) + 1 if t else 0 for t in spaced])
                stops = np.searchsorted(ends, stops, side="right")
                start = 0
                for stop in stops:
                    mine = [crc[start:stop], length[start:stop]]
                    n_words.append(stop - start)
                    found.append(np.concatenate([b.astype("<u4") for b in run_buckets(*mine, shifts, run, buckets)]).tobytes())
                    start = stop
                rest = [c.slice(part.start, len(spaced)) for i, c in enumerate(batch.columns) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(n_words, pa.int64()), pa.array(found, pa.binary())], names=names
                )

    kept = [docs.schema[c] for c in docs.columns if c != "text"]
    schema = StructType([*kept, StructField("n_words", LongType()), StructField("buckets", BinaryType())])
    return docs.mapInArrow(scan, schema)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features each bucket holds: a row per bucket from each partition, their sums on the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch.column(0).to_pylist():
                sums += np.bincount(np.frombuffer(found, "<u4"), minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some.astype(np.int32)), "n": pa.array(sums[some])})

    found = counters(features.select("buckets").mapInArrow(count, "bucket int, n bigint"), "bucket", "n")
    sums = np.zeros(buckets, np.int64)
    sums[found["bucket"]] = found["n"]
    return sums


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of how much likelier each bucket is in the target), one added to each count."""
    ratio = ((target + 1.0) * float(raw.sum() + raw.size)) / ((raw + 1.0) * float(target.sum() + raw.size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 times a Gumbel number), from the hash of ``seed:doc_id`` (nothing for a null id)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh_documents(docs: DataFrame, target: DataFrame, run: int = RUN_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each row of ``docs``."""
    features = written(feature_buckets(docs.select("doc_id", "text"), run, buckets), "features")
    wanted = feature_buckets(target.select("text"), run, buckets)
    model = docs.sparkSession.sparkContext.broadcast(  # one number for each bucket
        bucket_gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    )

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = model.value
        for batch in batches:
            sizes, weights = [], []
            for found in batch.column(2).to_pylist():
                mine = np.frombuffer(found, "<u4")
                sizes.append(mine.size)
                weights.append(int(gains[mine].sum()) // mine.size if mine.size else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    counts = [StructField(c, LongType()) for c in ("n_words", "n_features", "weight")]
    weighed = features.select("doc_id", "n_words", "buckets").mapInArrow(weigh, StructType([features.schema["doc_id"], *counts]))
    return weighed.withColumn("score", (F.col("weight") + gumbel(F.col("doc_id"), seed)).cast("bigint"))


def draw_documents(
    docs: DataFrame,
    target: DataFrame,
    run: int = RUN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    min_words: int = MIN_WORDS,
    percent: int = DRAW_PERCENT,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): a row for each row of ``docs``; rank is null unless it is drawn.

    Features are runs of 1 to ``run`` words, hashed to buckets by CRC. A document's weight is
    the mean log ratio of its features between ``target`` and ``docs``; with Gumbel noise from
    its id, the highest scores are a draw without replacement in proportion to the ratio.
    Of the documents with ``min_words`` words, ``percent`` % are drawn, ties to the smaller
    id (null first), then weight and number of features; rows that agree in all are
    interchangeable.

    Scores are whole numbers of a bounded range, so counts by score (some 10^5 rows at
    any size) find the score where the draw ends; only rows from there on are sorted.

    Null and empty texts have no features and weight 0. Rows that repeat an id are apart.
    An empty table gives none, an empty target makes all buckets equally rare there. Other columns are ignored.
    """
    weighed = written(weigh_documents(docs, target, run, buckets, seed), "weights")
    able = weighed.where(F.col("n_words") >= min_words)
    by_score = sorted(((r["score"], r["count"]) for r in able.groupBy("score").count().collect()), reverse=True)
    n_drawn, last, above = sum(n for _, n in by_score) * percent // 100, None, 0
    for score, n in by_score:
        if above >= n_drawn:
            break
        last, above = score, above + n
    columns = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return weighed.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    near = F.coalesce((F.col("n_words") >= min_words) & (F.col("score") >= last), F.lit(False))
    highest = weighed.where(near).select(*columns, (-F.col("score")).alias("_lost"), F.lit(0).alias("_all"))
    placed = with_ordinal(highest, ["_lost", "doc_id", "weight", "n_features"], "_all", "_nth")
    rank = F.when(F.col("_nth") < n_drawn, F.col("_nth") + 1).alias("rank")
    rest = weighed.where(~near).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return placed.select(*columns, rank).unionByName(rest)
