"""Operator 4. Toxicity of texts that are first restored from their disguise (noisy channel)."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptmill.llm.common import REMEMBERED_WORDS, columns, counters, hash_sample, raw_texts, remainder

# Labelled documents the classifier learns from, at most (those with the smallest hash of the id).
MAX_LABELLED = 200_000
# What a feature needs to be in the lexicon: toxic documents that have it, and their share.
MIN_TOXIC = 3
MIN_SHARE = 0.7
PRIOR_WEIGHT = 2.0
STEMS = (4, 5, 6)
# Score of a text without any evidence.
FLOOR = 0.01
THRESHOLD = 0.7

# What a sign may stand for, and the cost (a negative natural logarithm) of the disguise.
SIGNS = {
    b"0": b"o", b"1": b"il", b"2": b"z", b"3": b"e", b"4": b"a", b"5": b"s", b"6": b"g", b"7": b"t", b"8": b"b",
    b"9": b"g", b"@": b"a", b"$": b"s", b"!": b"il", b"|": b"il", b"+": b"t", b"(": b"c", b"<": b"c", b"*": b"aeiou",
}
DISGUISE = 1.0
REPEAT = 0.5
JOINT = b".-_*~'"

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
EDGE = b""".,;:!?"'()[]{}<>#%&*$|+-_~="""
# 26 letters, four classes of other letters' bytes, the border of words, everything else.
SYMBOLS = 32
BORDER, OTHER = 0, 31
CODES = np.full(256, OTHER, np.int64)
CODES[list(b" \t\n\x0b\x0c\r")] = BORDER
CODES[97:123] = np.arange(1, 27)
CODES[128:] = 27 + np.arange(128) % 4
SPACED = re.compile(rb"(?<![^\x20\x09-\x0D])[a-z0-9@$!|](?:[\x20\x09-\x0D._*-]{1,3}[a-z0-9@$!|]){2,}(?![^\x20\x09-\x0D.,;:!?])")
GAPS = re.compile(rb"[\x20\x09-\x0D._*-]+")
DISGUISED = re.compile(rb"[a-z\x80-\xff]", re.S)
SIGN = re.compile(rb"[0-9@$!|+(<*._~'-]|([a-z\x80-\xff])\1\1")
RUNS = re.compile(rb"(.)\1*", re.S)
JOINTS = re.compile(rb"[._*~'-]+")
# Shortest form that has features.
LEAST = 3

# What may stand at a place of a lattice: (letter, its code or -1 for nothing, cost).
Place = list[tuple[bytes, int, float]]


def character_model(docs: DataFrame) -> list[float]:
    """Cost of each symbol after two others, from the 3-grams of all texts with one added to each count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for text in raw_texts(batch.column(0)):
                codes = CODES[np.frombuffer(b" " + text.translate(LOWER) + b" ", np.uint8)]
                grams = (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]
                if grams.size > SYMBOLS**2:
                    sums += np.bincount(grams, minlength=SYMBOLS**3)
                else:
                    np.add.at(sums, grams, 1)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(some.astype(np.int32)), "n": pa.array(sums[some])})

    sums = counters(docs.select("text").mapInArrow(count, "gram int, n bigint"), "gram", "n")
    table = np.ones(SYMBOLS**3)
    table[sums["gram"]] += sums["n"]
    table = table.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    return (-np.log(table / table.sum(axis=2, keepdims=True))).ravel().tolist()


def run_places(sign: bytes, n: int) -> list[Place]:
    """What a run of ``n`` equal characters may stand for: one letter or two, or nothing for a joint."""
    if sign in SIGNS:
        letters = [SIGNS[sign][i : i + 1] for i in range(len(SIGNS[sign]))]
        options = [(letter, int(CODES[letter[0]]), DISGUISE) for letter in letters]
        if sign in JOINT:
            options.append((b"", -1, DISGUISE))
    elif sign in JOINT:
        options = [(b"", -1, REPEAT)]
    else:
        options = [(sign, int(CODES[sign[0]]), 0.0)]
    if n == 1:
        return [options]
    return [options, [*options, (b"", -1, REPEAT if n >= 3 else 2 * REPEAT)]]


class Places(dict):
    """Places of the lattice by character and length of its run, up to 3."""

    def __missing__(self, key: tuple[int, int]) -> list[Place]:
        places = self[key] = run_places(bytes(key[:1]), key[1])
        return places


PLACES = Places()
END: Place = [(b" ", BORDER, 0.0)]


def restored(word: bytes, costs: list[float]) -> bytes:
    """The most likely plain word behind a disguised one: Viterbi over its lattice.

    A state is the last two symbols, and there is a step back for each place and state, so
    work and memory grow with the length of the word alone. Of equally likely words the one
    whose letters are listed first wins.
    """
    places = [p for run in RUNS.finditer(word) for p in PLACES[word[run.start()], min(run.end() - run.start(), 3)]]
    paths, trail = {BORDER * SYMBOLS + BORDER: 0.0}, []
    for options in [*places, END]:
        onward: dict[int, float] = {}
        back: dict[int, tuple[int, bytes]] = {}
        for state, cost in paths.items():
            for letter, code, price in options:
                if code < 0:
                    to, total = state, cost + price
                else:
                    to, total = state % SYMBOLS * SYMBOLS + code, cost + price + costs[state * SYMBOLS + code]
                if to not in onward or total < onward[to]:
                    onward[to], back[to] = total, (state, letter)
        paths = onward
        trail.append(back)
    state, letters = min(paths, key=paths.__getitem__), []
    for back in reversed(trail):
        state, letter = back[state]
        letters.append(letter)
    return b"".join(reversed(letters)).strip()


def forms(word: bytes, costs: list[float]) -> set[bytes]:
    """The plain and the restored forms of a word, and its parts between joints."""
    plain = word.strip(EDGE)
    found = {plain}
    for form in {plain, word.strip(b""".,;:?"'[]{}#%&""")}:
        if SIGN.search(form) and DISGUISED.search(form):
            found.add(restored(form, costs))
            found.update(JOINTS.split(form))
    return {form for form in found if len(form) >= LEAST}


def features(word: bytes, costs: list[float]) -> set[bytes]:
    """The forms of a word (marked by a final space) and their beginnings."""
    found = set()
    for form in forms(word, costs):
        found.add(form + b" ")
        found.update(form[:n] for n in STEMS if len(form) > n)
    return found


class Lexicon:
    """Shares of features; forms are looked up only if some feature begins as they do."""

    def __init__(self, shares: dict[bytes, float]) -> None:
        self.shares = shares
        self.heads = {feature[:LEAST] for feature in shares}

    def best(self, word: bytes, costs: list[float]) -> float:
        """Greatest share of the features of a word."""
        share = self.shares.get
        return max(
            (
                share(feature, 0.0)
                for form in forms(word, costs)
                if form[:LEAST] in self.heads
                for feature in (form + b" ", *(form[:n] for n in STEMS if len(form) > n))
            ),
            default=0.0,
        )


def tokens(text: bytes) -> set[bytes]:
    """Distinct words in lower case, and single characters set apart joined again.

    A one-letter word may stand beside such a row, so it is joined without its ends, too.
    """
    low = text.translate(LOWER)
    found = set(low.split())
    for match in SPACED.finditer(low):
        row = GAPS.sub(b"", match.group())
        found |= {row, row[1:], row[:-1], row[1:-1]}
    return found


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> dict[int, int]:
    """Label by id of the documents to learn from: at most ``limit``, one of each text.

    Conflicting labels of an id or a text count as toxic.
    """
    mine = F.coalesce(remainder(F.col("doc_id"), 3) != 1, F.lit(False))
    marked = labels.where(mine & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = marked.join(hash_sample(marked.select("doc_id"), limit), "doc_id")
    texts = docs.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))
    rows = columns(
        texts.join(F.broadcast(sample), "doc_id")  # at most ``limit`` ids
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
        .select("doc_id", "toxic")
    )
    return dict(zip(rows["doc_id"].tolist(), rows["toxic"].tolist(), strict=True))


def toxic_lexicon(docs: DataFrame, labels: DataFrame, costs: list[float], limit: int = MAX_LABELLED) -> dict[bytes, float]:
    """Features and the smoothed share of toxic documents among those that have them.

    Only features of the labelled sample are in it, each in MIN_TOXIC of its documents or more.
    """
    sample = labelled_sample(docs, labels, limit)
    if not any(sample.values()):
        return {}
    context = docs.sparkSession.sparkContext
    known, model = context.broadcast(sample), context.broadcast(costs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[bytes, set[bytes]] = {}
        toxic: Counter[bytes] = Counter()
        clean: Counter[bytes] = Counter()
        used: set[int] = set()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
                label = known.value.get(doc_id)
                if label is None or doc_id in used:
                    continue
                used.add(doc_id)
                if len(memory) > REMEMBERED_WORDS:
                    memory.clear()
                found: set[bytes] = set()
                for word in tokens(text):
                    if word not in memory:
                        memory[word] = features(word, model.value)
                    found |= memory[word]
                (toxic if label else clean).update(found)
        # a feature of the lexicon may still be toxic in other partitions only
        names = list(toxic.keys() | clean.keys())
        for start in range(0, len(names), 50_000):
            part = names[start : start + 50_000]
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(part, pa.binary()),
                    "n_toxic": pa.array([toxic[f] for f in part], pa.int64()),
                    "n_clean": pa.array([clean[f] for f in part], pa.int64()),
                }
            )

    prior = sum(sample.values()) / len(sample)
    share = (F.col("n_toxic") + PRIOR_WEIGHT * prior) / (F.col("n_toxic") + F.col("n_clean") + PRIOR_WEIGHT)
    rows = (
        docs.select("doc_id", "text")
        .mapInArrow(count, "feature binary, n_toxic bigint, n_clean bigint")
        .groupBy("feature")
        .agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
        .where(F.col("n_toxic") >= MIN_TOXIC)
        .withColumn("share", share)
        .where(F.col("share") >= MIN_SHARE)
        .select("feature", "share")
        .collect()
    )
    return {bytes(r["feature"]): r["share"] for r in rows}


def score_toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, limit: int = MAX_LABELLED
) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row for each row of ``docs``.

    A character model of all texts decodes leetspeak, spacing, joints and repetition. The
    lexicon holds words and beginnings of words, plain or restored, that are mostly in
    toxic documents of the labelled sample (ids whose crc32 leaves no 1 modulo 3); one minus
    the product of what each distinct word leaves open is the score.

    Words of any length are decoded, rows of three single characters or more are joined, words with
    joints count with their parts, too. Null and empty texts, and all texts where nothing toxic was learned, get the floor.
    A null id is not held out and never learned from. Repeated rows are scored each and
    learned from once. Scores read the text only.
    """
    costs = character_model(docs)
    lexicon = toxic_lexicon(docs, labels, costs, limit)
    context = docs.sparkSession.sparkContext
    model, terms = context.broadcast(costs), context.broadcast(lexicon)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[bytes, float] = {}
        table, known = model.value, Lexicon(terms.value)
        for batch in batches:
            scores = []
            for text in raw_texts(batch.column(2)):
                if len(memory) > REMEMBERED_WORDS:
                    memory.clear()
                left = 0.0
                for word in tokens(text) if known.shares else ():
                    if word not in memory:
                        memory[word] = math.log1p(-known.best(word, table))
                    left += memory[word]
                scores.append(1 - (1 - FLOOR) * math.exp(left))
            values = np.round(np.array(scores, float), 9)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values), pa.array((values >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out, "text").mapInArrow(
        score, f"doc_id {doc_id}, held_out boolean, score double, predicted int"
    )
