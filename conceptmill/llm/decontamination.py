"""Operator 9. Benchmark decontamination with spaced seeds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptmill.llm.common import WordHashes, bit_filter, in_chunks, may_hold, raw_texts, written

# Positions of a window that count (1) and that may differ (0). No leak is without a seed: one from
# 20 words on has a part of 10 to 19 words that is a leak, and in that there are 10 words with two
# different ones at most, of which one of the first five masks avoids any two, or else 15 with three,
# all among the middle five, which the last one leaves out.
MASKS = ("1110111", "11011011", "1110000111", "111111", "1101001011", "111110000011111")
# An overlap counts from this many words, with this share of them equal in place, in percent.
MIN_OVERLAP = 10
SAME_PERCENT = 80
# Bits of the filter sent to the tasks: 8 MB, whatever the benchmark.
FILTER_BITS = 26

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
PUNCTUATION = b"""!"'(),.:;?[]{}"""
MULTIPLIERS = np.random.default_rng(7).integers(1 << 62, 1 << 63, max(map(len, MASKS)), dtype=np.uint64) | np.uint64(1)


def plain_words(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z) without punctuation."""
    return text.translate(LOWER, PUNCTUATION).split()


def whole_mask(n_words: int) -> str:
    """Mask of an item with fewer words than an overlap needs: all of them count."""
    return "1" * n_words + "|"


def seeds_of(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the counting positions of every window."""
    bits = mask.rstrip("|")
    n = hashes.size - len(bits) + 1
    sums = np.full(max(n, 0), xxhash.xxh3_64_intdigest(mask), np.uint64)
    for at, bit in enumerate(bits):
        if bit == "1" and n > 0:
            sums += hashes[at : at + n] * MULTIPLIERS[at]
    sums ^= sums >> np.uint64(29)
    sums *= np.uint64(0x9E3779B97F4A7C15)
    return sums ^ (sums >> np.uint64(32))


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = WordHashes()
    for batch in batches:
        for text in raw_texts(batch.column(0)):
            found = plain_words(text)
            hashes, key = memory.of(found), xxhash.xxh3_128_digest(b" ".join(found))
            for mask in MASKS if len(found) >= MIN_OVERLAP else [whole_mask(len(found))] if found else []:
                seeds = seeds_of(hashes, mask)
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_key": pa.array([key] * seeds.size, pa.binary()),
                        "seed": pa.array(seeds.view(np.int64)),
                        "item_at": pa.array(np.arange(seeds.size, dtype=np.int64)),
                    }
                )


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [plain_words(text) for text in raw_texts(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([xxhash.xxh3_128_digest(b" ".join(w)) for w in found], pa.binary()),
                pa.array([b" ".join(w).decode("utf-8", "replace") for w in found], pa.string()),
                pa.array([len(w) for w in found], pa.int64()),
            ],
            names=["item_id", "item_key", "item_words", "n_words"],
        )


def seed_hits(docs: DataFrame, packed: np.ndarray, masks: list[str]) -> DataFrame:
    """(doc_id, doc_key, doc_words, seeds, places) of documents with a window in the filter."""
    bits = docs.sparkSession.sparkContext.broadcast(packed)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, table = WordHashes(), bits.value

        for batch in batches:
            texts = raw_texts(batch.column(1))
            for part in in_chunks(texts):
                found = [plain_words(text) for text in texts[part]]
                sizes = [len(w) for w in found]
                starts = np.cumsum([0, *sizes])
                owner = np.repeat(np.arange(len(found)), sizes)
                hashes = memory.of([w for doc in found for w in doc])
                hits: dict[int, list[tuple[int, int]]] = {}
                for mask in masks:
                    seeds = seeds_of(hashes, mask)
                    last = owner[owner.size - seeds.size :]
                    some = np.flatnonzero(may_hold(table, seeds) & (owner[: seeds.size] == last))
                    for at, seed in zip(some.tolist(), seeds[some].view(np.int64).tolist(), strict=True):
                        doc = int(owner[at])
                        hits.setdefault(doc, []).append((seed, at - int(starts[doc])))
                docs_hit = sorted(hits)
                joined = [b" ".join(found[d]) for d in docs_hit]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([part.start + d for d in docs_hit], pa.int64())),
                        pa.array([xxhash.xxh3_128_digest(w) for w in joined], pa.binary()),
                        pa.array([w.decode("utf-8", "replace") for w in joined], pa.string()),
                        pa.array([[s for s, _ in hits[d]] for d in docs_hit], pa.list_(pa.int64())),
                        pa.array([[p for _, p in hits[d]] for d in docs_hit], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "doc_key", "doc_words", "seeds", "places"],
                )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        find, f"doc_id {doc_id}, doc_key binary, doc_words string, seeds array<bigint>, places array<bigint>"
    )


def longest_overlap(doc: list[bytes], item: list[bytes], shift: int) -> tuple[int, int, int, int]:
    """(start in the document, start in the item, words, equal words) of the longest leak, zeros without one.

    The item is laid on the document with its word 0 at ``shift``. Of all stretches of
    MIN_OVERLAP words or more with a share of SAME_PERCENT equal, the longest wins, the first of
    equals. In the sums of what each word has above that share, such a stretch ends no lower
    than it starts; a longest one starts at a new minimum, and is met first from the right.
    """
    start = max(0, -shift)
    stop = min(len(item), len(doc) - shift)
    above, same, lows = [0], [0], [0]
    for at in range(start, stop):
        match = item[at] == doc[at + shift]
        above.append(above[-1] + (100 - SAME_PERCENT if match else -SAME_PERCENT))
        same.append(same[-1] + match)
        if above[-1] < above[lows[-1]]:
            lows.append(len(above) - 1)
    result = (0, 0, 0, 0)
    for end in range(len(above) - 1, 0, -1):
        while lows and above[end] >= above[lows[-1]]:
            low = lows.pop()
            if end - low >= max(MIN_OVERLAP, result[2]):
                result = (start + low + shift, start + low, end - low, same[end] - same[low])
    return result


def whole_item(doc: list[bytes], item: list[bytes], shift: int) -> tuple[int, int, int, int]:
    """What ``longest_overlap`` gives, for an item that has to stand in the document as it is."""
    n = len(item)
    return (shift, 0, n, n) if doc[shift : shift + n] == item else (0, 0, 0, 0)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, rows = [], []
        columns = (batch.column(i).to_pylist() for i in range(2, 5))
        for at, (doc_words, item_words, shifts) in enumerate(zip(*columns, strict=True)):
            doc, item = doc_words.split(" "), item_words.split(" ")
            overlap = longest_overlap if len(item) >= MIN_OVERLAP else whole_item
            found = max((overlap(doc, item, shift) for shift in shifts), key=lambda x: (x[2], x[3], -x[0], -x[1]))
            if found[2]:
                kept.append(at)
                rows.append((*found, len(item)))
        take = pa.array(kept, pa.int64())
        values = np.array(rows, np.int64).reshape(-1, 5)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), *map(pa.array, values.T)],
            names=["doc_key", "item_key", "doc_start", "item_start", "n_overlap", "n_same", "n_item"],
        )


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_overlap, n_same, n_item) of contaminated documents.

    Words are lower-cased (A-Z) and stripped of punctuation. Masks ignore some
    positions of a window; windows of documents whose seed may be in the benchmark (a filter of
    fixed size tells) are joined with the benchmark's seeds. Around every hit the item is
    laid on the document and the longest stretch from 10 words with 80 % equal is a leak.
    One row for each (row, item), the longest stretch (then the one with the most equal
    words, then the first) when the item occurs more than once.

    An item of fewer than 10 words is a leak where all its words stand in a row, unchanged.

    Equal texts are verified once. Null texts and items without words never match. Repeated document or item rows give a row each. Empty tables give none.
    """
    items = written(benchmark.select("item_id", "text").mapInArrow(
        _items, f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, item_key binary, item_words string, n_words bigint"
    ), "benchmark-items")
    unique_items = items.groupBy("item_key").agg(F.first("item_words").alias("item_words"))
    seeds = written(
        unique_items.select("item_words").mapInArrow(_item_seeds, "item_key binary, seed bigint, item_at bigint"),
        "benchmark-seeds",
    )
    short = items.where(F.col("n_words").between(1, MIN_OVERLAP - 1)).select("n_words").distinct().collect()
    masks = [*MASKS, *(whole_mask(r["n_words"]) for r in short)]
    hits = written(seed_hits(docs, bit_filter(seeds.select("seed"), FILTER_BITS), masks), "seed-hits")
    unique_docs = hits.groupBy("doc_key").agg(
        F.first("doc_words").alias("doc_words"), F.first("seeds").alias("seeds"), F.first("places").alias("places")
    )
    windows = unique_docs.select(
        "doc_key", F.explode(F.arrays_zip("seeds", "places")).alias("hit")
    ).select("doc_key", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("doc_at"))
    pairs = (
        windows.join(seeds, "seed")
        .groupBy("doc_key", "item_key")
        .agg(F.collect_set(F.col("doc_at") - F.col("item_at")).alias("shifts"))
    )
    found = (
        pairs.join(unique_docs.select("doc_key", "doc_words"), "doc_key")
        .join(unique_items, "item_key")
        .select("doc_key", "item_key", "doc_words", "item_words", "shifts")
        .mapInArrow(
            _verify,
            "doc_key binary, item_key binary, doc_start bigint, item_start bigint, n_overlap bigint, n_same bigint, n_item bigint",
        )
    )
    return (
        found.join(hits.select("doc_id", "doc_key"), "doc_key")
        .join(items.select("item_id", "item_key"), "item_key")
        .select("doc_id", "item_id", "doc_start", "item_start", "n_overlap", "n_same", "n_item")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text has no leak, with all their columns; null, repeated or clashing ids do not matter."""
    by_text = docs.select(F.md5(F.col("text").cast("binary")).alias("doc_id"), "text")
    leaks = written(find_leaks(by_text, benchmark).select(F.col("doc_id").alias("digest")).distinct(), "leaks")
    return docs.join(leaks, F.md5(docs["text"].cast("binary")) == leaks["digest"], "left_anti")
