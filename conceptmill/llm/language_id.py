"""Operator 10. Language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptmill.llm.common import columns, in_chunks, raw_texts, remainder

DIMENSIONS = 1024
UNKNOWN = "und"
# n-gram vectors one worker keeps.
REMEMBERED_GRAMS = 20_000


class LetterCodes:
    """For every code point: the code point of its lower-case letter, or 0 if it is no letter."""

    def __init__(self) -> None:
        self.codes = np.full(0x110000, -1, np.int64)

    def of(self, points: np.ndarray) -> np.ndarray:
        codes = self.codes[points]
        if codes.size and codes.min() < 0:
            for point in np.unique(points[codes < 0]).tolist():
                char = chr(point)
                low = char.lower()
                self.codes[point] = (ord(low) if len(low) == 1 else point) if char.isalpha() else 0
            codes = self.codes[points]
        return codes


def letter_grams(text: bytes, letters: LetterCodes) -> np.ndarray:
    """Keys of the 3-grams of a text: letters, and one 0 for each run of other characters."""
    codes = letters.of(np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32))
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
    codes = codes[(codes > 0) | np.concatenate([[True], codes[:-1] > 0])]
    if codes.size < 3:
        return np.empty(0, np.uint64)
    return codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]


class GramVectors:
    """Vectors of 3-grams: two, one and no rotations of its letters' random vectors, multiplied."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.dimensions = dimensions
        self.codes = LetterCodes()
        self.letters: dict[int, np.ndarray] = {}
        self.places: dict[int, int] = {}
        self.vectors = np.empty((1024, dimensions), np.float32)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng(code).choice(np.array([-1, 1], np.int8), self.dimensions)
        return self.letters[code]

    def places_of(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key in ``vectors``, adding what is new."""
        if len(self.places) > REMEMBERED_GRAMS:
            self.places.clear()
        new = [k for k in keys.tolist() if k not in self.places]
        if new:
            mask = (1 << 21) - 1
            while len(self.places) + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
            for k in new:
                at = self.places[k] = len(self.places)
                first, second, third = (self.letter(k >> shift & mask) for shift in (42, 21, 0))
                self.vectors[at] = np.roll(first, 2) * np.roll(second, 1) * third
        return np.fromiter(map(self.places.__getitem__, keys.tolist()), np.int64, keys.size)

    def bundled(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Unit vector of each text (zero if it has no letter), and whether it has one."""
        out = np.zeros((len(texts), self.dimensions), np.float32)
        found = np.zeros(len(texts), bool)
        for i, text in enumerate(texts):
            grams = letter_grams(text, self.codes)
            if grams.size and np.any(grams & np.uint64((1 << 21) - 1 << 21)):
                keys, times = np.unique(grams, return_counts=True)
                places = self.places_of(keys)
                out[i] = times.astype(np.float32) @ self.vectors[places]
                length = float(np.linalg.norm(out[i]))
                found[i] = length > 0
                out[i] /= length or 1.0
        return out, found


def language_prototypes(docs: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages in order and the unit sum of the vectors of their documents.

    Learns from the documents with a language whose crc32 of the id leaves no 2 modulo 4.
    A partition sends one vector per language; languages are a fixed, small set.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sums = GramVectors(dimensions), {}
        for batch in batches:
            texts, langs = raw_texts(batch.column(0)), batch.column(1).to_pylist()
            for part in in_chunks(texts):
                made, _ = vectors.bundled(texts[part])
                for lang, vector in zip(langs[part], made, strict=True):
                    sums[lang] = sums.get(lang, 0) + vector.astype(np.float64)
        at = np.arange(dimensions, dtype=np.int32)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * dimensions, "at": at, "value": np.round(vector * 2**32).astype(np.int64)})

    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    parts = docs.where(F.col("lang").isNotNull() & ~held_out).select("text", "lang")
    sums = columns(
        parts.mapInArrow(bundle, "lang string, at int, value bigint")
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
    )
    langs = sorted(set(sums["lang"].tolist()))
    table = np.zeros((len(langs), dimensions))
    table[[langs.index(lang) for lang in sums["lang"]], sums["at"]] = sums["value"]
    return langs, (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1)).astype(np.float32)


def identify_languages(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): one row for each row of ``docs``.

    A document is the sum of the vectors of its letter 3-grams. The language whose prototype
    has the largest cosine wins, the first by name in a tie; score is half of one plus
    that cosine. Null and empty texts, texts without a letter, and all texts when nothing
    could be learned get ``und`` and 0. A null id is not held out. Repeated rows are scored
    each. Only text and id are read for a prediction.
    """
    langs, table = language_prototypes(docs, dimensions)
    model = docs.sparkSession.sparkContext.broadcast(table)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = GramVectors(dimensions)
        for batch in batches:
            texts = raw_texts(batch.column(2))
            names, scores = [], []
            for part in in_chunks(texts):
                made, found = vectors.bundled(texts[part])
                cosines = made @ model.value.T if langs else np.zeros((len(made), 1))
                best = cosines.argmax(axis=1)
                known = found & bool(langs)
                names += [langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                scores += np.where(known, np.clip((1 + cosines.max(axis=1)) / 2, 0, 1), 0.0).astype(float).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out, "text").mapInArrow(
        predict, f"doc_id {doc_id}, held_out boolean, lang_pred string, score double"
    )
