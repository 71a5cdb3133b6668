"""Operator 12. License scans: exact set-similarity join of text blocks with license templates.

A block holds BLOCK_WORDS words and starts every STEP words, so a passage of up to STEP + 1 words
stands whole in one block, wherever it is. A template is found in a block that holds THRESHOLD
percent of its distinct words. Words are ordered by their number in all documents, rarest first.
Of a template with s words, of which o are needed, one of the s - o + 1 rarest has to be in the block
(prefix); the block needs o words of templates (length); and behind the first common word both
sides need enough words (position). What passes is counted exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from conceptmill.llm.common import counters, in_chunks, raw_texts, written

BLOCK_WORDS, STEP = 64, 32
THRESHOLD = 85
# Phrases that name a license, and sentences of public licenses.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
TEMPLATES = (
    ("agpl", "GNU Affero General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("cc-by", "Licensed under a Creative Commons Attribution License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC"),
    ("cc-by-sa", "Licensed under CC BY-SA"),
    ("cc-by-nd", "Licensed under CC BY-ND"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("lgpl", "GNU Lesser General Public License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("mit", "Released under the MIT License"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

# A-Z become a-z; other ASCII than letters and digits becomes a space.
FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
BETWEEN, UNKNOWN = -2, -1


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLDED).split()


def needed(size: int, threshold: int = THRESHOLD) -> int:
    """Common words that a template of ``size`` words needs."""
    return max(1, -(-size * threshold // 100))


class Reader:
    """Texts as numbers of known words."""

    def __init__(self, known: Sequence[bytes]) -> None:
        self.ids = {word: i for i, word in enumerate(known)}

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of all words (BETWEEN after each text), where each text starts, and its number of words."""
        parts, sizes = [], []
        for text in texts:
            found = text.translate(FOLDED).split()
            sizes.append(len(found))
            parts.append(np.fromiter(map(self.ids.get, found, repeat(UNKNOWN)), np.int32, len(found)))
            parts.append(np.array([BETWEEN], np.int32))
        n_words = np.array(sizes, np.int64)
        starts = np.cumsum(n_words + 1) - n_words - 1
        return np.concatenate(parts) if parts else np.empty(0, np.int32), starts, n_words


def known_words(templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]) -> list[bytes]:
    return sorted({w for _, text in (*templates, *phrases) for w in words_of(text)})


def word_order(docs: DataFrame, known: list[bytes]) -> list[bytes]:
    """``known`` words from the rarest in all texts to the most frequent: a row per word from each partition."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, sums = Reader(known), np.zeros(len(known), np.int64)
        for batch in batches:
            texts = raw_texts(batch.column(0))
            for part in in_chunks(texts):
                ids = reader.read(texts[part])[0]
                sums += np.bincount(ids[ids >= 0], minlength=len(known))
        yield pa.RecordBatch.from_pydict({"word": pa.array(np.arange(len(known), dtype=np.int32)), "n": pa.array(sums)})

    found = counters(docs.select("text").mapInArrow(count, "word int, n bigint"), "word", "n")
    n = dict(zip(found["word"].tolist(), found["n"].tolist(), strict=True))
    return [known[i] for i in sorted(range(len(known)), key=lambda i: (n.get(i, 0), known[i]))]


def template_index(
    order: list[bytes], templates: Sequence[tuple[str, str]], threshold: int = THRESHOLD
) -> list[tuple[int, int, str, int, int, int, list[int]]]:
    """(word, template, label, place, size, least, words) for each word in the prefix of a template."""
    rank, rows = {w: i for i, w in enumerate(order)}, []
    for number, (label, text) in enumerate(templates):
        found = words_of(text)
        if not 0 < len(found) <= STEP + 1:
            raise ValueError(f"a template has 1 to {STEP + 1} words: {text}")
        words = sorted({rank[w] for w in found})
        least = needed(len(words), threshold)
        rows += [(w, number, label, at, len(words), least, words) for at, w in enumerate(words[: len(words) - least + 1])]
    return rows


INDEX = "word int, template int, label string, place int, size int, least int, words array<int>"


def _phrase_places(ids: np.ndarray, phrase: list[int]) -> np.ndarray:
    if ids.size < len(phrase):
        return np.empty(0, np.int64)
    hit = np.ones(ids.size - len(phrase) + 1, bool)
    for at, word in enumerate(phrase):
        hit &= ids[at : at + hit.size] == word
    return np.flatnonzero(hit)


def _candidate_blocks(ids: np.ndarray, starts: np.ndarray, n_words: np.ndarray, prefixes: np.ndarray) -> dict[int, list[dict]]:
    """For each text the blocks that hold a word of a template's prefix, with their known words in order."""
    places = np.flatnonzero(prefixes[ids])  # UNKNOWN and BETWEEN are the last two, never set
    texts = np.searchsorted(starts, places, side="right") - 1
    blocks = (places - starts[texts]) // STEP
    both = np.unique(np.concatenate([np.stack([texts, blocks]), np.stack([texts, blocks - 1])], axis=1), axis=1)
    found: dict[int, list[dict]] = {}
    for text, block in both.T.tolist():
        if block < 0 or (block and block * STEP + BLOCK_WORDS - STEP >= n_words[text]):
            continue
        start = starts[text] + block * STEP
        held = np.unique(ids[start : min(start + BLOCK_WORDS, starts[text] + n_words[text])])
        found.setdefault(text, []).append({"block": block, "words": held[held >= 0].tolist()})
    return found


def scan_documents(
    docs: DataFrame, order: list[bytes], prefix_words: list[int], phrases: Sequence[tuple[str, str]] = PHRASES
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base (labels), and blocks that may hold a template."""
    rank = {w: i for i, w in enumerate(order)}
    wanted = [(label, [rank[w] for w in words_of(text)]) for label, text in phrases]
    prefixes = np.zeros(len(order) + 2, bool)
    prefixes[prefix_words] = True
    names = sorted({label for label, _ in phrases})
    block = StructType([StructField("block", IntegerType()), StructField("words", ArrayType(IntegerType()))])
    longs = [StructField(c, LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    schema = StructType(
        [docs.schema["doc_id"], *longs, StructField("base", ArrayType(StringType())), StructField("blocks", ArrayType(block))]
    )
    arrow_block = pa.list_(pa.struct([("block", pa.int32()), ("words", pa.list_(pa.int32()))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(order)
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for part in in_chunks(texts):
                ids, starts, n_words = reader.read(texts[part])
                n = n_words.size
                hits = [(label, _phrase_places(ids, phrase)) for label, phrase in wanted]
                places = np.concatenate([p for _, p in hits])
                owner = np.searchsorted(starts, places, side="right") - 1
                first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                np.minimum.at(first, owner, places - starts[owner])
                np.maximum.at(last, owner, places - starts[owner])
                labels: list[set[str]] = [set() for _ in range(n)]
                for label, found in hits:
                    for text in np.unique(np.searchsorted(starts, found, side="right") - 1).tolist():
                        labels[text].add(label)
                blocks = _candidate_blocks(ids, starts, n_words, prefixes)
                none = last < 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.start, n),
                        pa.array(n_words),
                        pa.array(np.bincount(owner, minlength=n)),
                        pa.array(first, mask=none),
                        pa.array(last, mask=none),
                        pa.array([[x for x in names if x in some] for some in labels], pa.list_(pa.string())),
                        pa.array([blocks.get(i, []) for i in range(n)], arrow_block),
                    ],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base", "blocks"],
                )

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def matching_blocks(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """(_uid, block, template, label, share) of blocks that hold enough of a template.

    ``blocks`` has _uid, block and words (numbers in order of frequency), ``index`` is that of
    the templates, whose size is known when the plan is made.
    """
    probes = blocks.select("_uid", "block", "words", F.posexplode("words").alias("block_place", "word"))
    on = index.withColumnRenamed("words", "template_words")
    behind = F.least(F.size("words") - F.col("block_place"), F.col("size") - F.col("place"))
    common = F.size(F.array_intersect("words", "template_words"))
    return (
        probes.where(F.size("words") > 0)
        .join(on, "word")
        .where((F.size("words") >= F.col("least")) & (behind >= F.col("least")))
        .withColumn("common", common)
        .where(F.col("common") >= F.col("least"))
        .groupBy("_uid", "block", "template", "label")
        .agg(F.max(F.col("common") / F.col("size")).alias("share"))
    )


def find_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base, labels, notices, score): a row for each row of ``docs``.

    base: labels of the phrases whose words stand in a row, n_base: their places, first_word and
    last_word the least and the greatest. labels: base and those of templates found in a block.
    notices: (block, template, label, share) of all blocks that hold a template. score: the
    greatest share of a template in a block that holds it, 1 with a phrase, else 0.

    ``templates`` and ``phrases`` are lists of (label, text) that every task holds; a template
    has at most 33 words. A null or empty text has no words, labels or notices. Rows that repeat
    id and text have a row each. An empty table gives none. Other columns are ignored.
    """
    order = word_order(docs, known_words(templates, phrases))
    rows = template_index(order, templates, threshold)
    scanned = scan_documents(docs, order, sorted({r[0] for r in rows}), phrases)
    scanned = written(scanned.withColumn("_uid", F.monotonically_increasing_id()), "license-blocks")
    blocks = scanned.select("_uid", F.inline("blocks"))
    found = matching_blocks(blocks, docs.sparkSession.createDataFrame(rows, INDEX))
    notice = F.struct("block", "template", "label", "share")
    notices = found.groupBy("_uid").agg(F.sort_array(F.collect_list(notice)).alias("notices"))
    none = F.array().cast(notices.schema["notices"].dataType)
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("notices", lambda x: x["label"]))))
    best = F.coalesce(F.array_max(F.transform("notices", lambda x: x["share"])), F.lit(0.0))
    return (
        scanned.join(notices, "_uid", "left")
        .withColumn("notices", F.coalesce("notices", none))
        .select(
            "doc_id", "n_words", "n_base", "first_word", "last_word", "base", labels.alias("labels"), "notices",
            F.when(F.col("n_base") > 0, 1.0).otherwise(best).alias("score"),
        )
    )


def sql_list(items: Sequence[tuple[str, str]]) -> str:
    """(label, text) rows for a VALUES list, words in lower case with single spaces."""
    return ", ".join(f"('{label}', '{b' '.join(words_of(re.sub(chr(39), ' ', text))).decode()}')" for label, text in items)
