"""Operator 3. Quality: log-likelihood ratio of hashed n-grams, trusted target against raw corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptmill.llm.common import REMEMBERED_WORDS, SPACE_BYTES, counters, hash_sample, raw_texts, slices

# Buckets of the hashed n-grams (a prime): the size of the model, whatever the corpus.
BUCKETS = 32_749
# Documents the target multinomial is fitted on, at most: trusted ids, those with the smallest hash.
MAX_TRUSTED = 200_000
# A document stays if its mean log ratio per n-gram is at least this.
THRESHOLD = -0.1
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


class Words(dict):
    """Id and hash of each word seen; forgotten between documents when there are too many."""

    def __init__(self) -> None:
        self.hashes = np.empty(1 << 16, np.int64)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        if at == self.hashes.size:
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
        self.hashes[at] = int.from_bytes(hashlib.md5(word).digest()[:4])
        return at

    def of(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and hashes of the words of one document."""
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        ids = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        return ids, self.hashes[ids]


def ngram_buckets(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the words and of the pairs of adjacent words."""
    return np.concatenate([hashes % BUCKETS, (hashes[:-1] * 31 + hashes[1:]) % BUCKETS])


def repeated_words(ids: np.ndarray) -> int:
    """Words in 3-word windows that occur twice or more."""
    if ids.size < 4:
        return 0
    pairs = np.unique(ids[:-1] << 32 | ids[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] << 32 | ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    covered = np.zeros(ids.size, bool)
    for shift in range(3):
        covered[shift : shift + again.size] |= again
    return int(covered.sum())


def trusted_ids(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """Distinct ids of documents labelled as good, at most ``limit`` of them (chosen by hash)."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return hash_sample(good, limit)


def log_ratios(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRUSTED) -> np.ndarray:
    """ln p(bucket | trusted) - ln p(bucket | raw), each with one added to every count."""
    trusted = trusted_ids(labels, limit).select(F.col("doc_id").alias("trusted_id"))
    marked = docs.select("doc_id", "text").join(
        F.broadcast(trusted),  # at most ``limit`` ids
        F.col("doc_id") == F.col("trusted_id"),
        "left",
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, raw, target = Words(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches):
            for text, is_good in zip(raw_texts(batch.column(1)), batch.column(0).to_pylist(), strict=True):
                found = ngram_buckets(memory.of(text.split())[1])
                once = np.bincount(found, minlength=BUCKETS) if found.size > BUCKETS // 8 else None
                for sums in (raw, target) if is_good else (raw,):
                    if once is None:
                        np.add.at(sums, found, 1)
                    else:
                        sums += once
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(some.astype(np.int32)), "raw": pa.array(raw[some]), "target": pa.array(target[some])}
        )

    parts = marked.select(F.isnotnull("trusted_id").alias("good"), "text").mapInArrow(
        count, "bucket int, raw bigint, target bigint"
    )
    sums = counters(parts, "bucket", "raw", "target")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[sums["bucket"]], target[sums["bucket"]] = sums["raw"], sums["target"]
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def _schema(docs: DataFrame) -> str:
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return f"doc_id {doc_id}, {', '.join(f'{c} bigint' for c in BASE)}, llr double, base_failed boolean, kept boolean"


def _measures(column: pa.Array, memory: Words, ratios: np.ndarray, threshold: float) -> list[pa.Array]:
    """Base measures, log ratio, base_failed and kept of a column of texts."""
    rows, llr = [], []
    points = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
    for text, length in zip(raw_texts(column), points, strict=True):
        ids, hashes = memory.of(text.split())
        lines = [line for line in text.split(b"\n") if line.strip()]
        spaces = len(text) - len(text.translate(None, SPACE_BYTES))
        symbols = len(text) - len(text.translate(None, SYMBOLS))
        rows.append((ids.size, length - spaces, symbols, len(lines) - len(set(lines)), repeated_words(ids)))
        grams = ngram_buckets(hashes)
        llr.append(float(ratios[grams].mean()) if grams.size else 0.0)
    base = np.array(rows, np.int64).reshape(-1, len(BASE))
    ratio = np.array(llr, float)
    failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > 50 * base[:, 0])
    return [*map(pa.array, base.T), pa.array(ratio), pa.array(failed), pa.array(~failed & (ratio >= threshold))]


def score_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, limit: int = MAX_TRUSTED
) -> DataFrame:
    """(doc_id, five base measures, llr, base_failed, kept): one row for each row of ``docs``.

    The trusted target is the documents that ``labels`` calls good, the raw corpus is all
    documents; both are multinomials over hashed words and word pairs. ``llr`` is the mean
    log ratio per n-gram, so length does not count. Counts leave each partition as one row
    per bucket, the model is one number per bucket.

    A null or empty text has no words, llr 0, and fails the base rule. Repeated rows are
    scored and counted each. Ids may be of any type; a null id is never trusted. Without trusted documents the
    ratio measures how common n-grams are. Other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, labels, limit))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Words()
        for batch in slices(batches):
            measured = _measures(batch.column(1), memory, model.value, threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *measured], names=["doc_id", *BASE, "llr", "base_failed", "kept"]
            )

    return docs.select("doc_id", "text").mapInArrow(score, _schema(docs))


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, limit: int = MAX_TRUSTED
) -> DataFrame:
    """Rows of ``docs`` that score_quality keeps, with all their columns, in one pass without a join."""
    model = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, labels, limit))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Words()
        for batch in slices(batches):
            yield batch.filter(_measures(batch.column(at), memory, model.value, threshold)[-1])

    return docs.mapInArrow(keep, docs.schema)
