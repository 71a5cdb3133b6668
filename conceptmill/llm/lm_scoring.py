"""Operator 1. Language-model scores from a hidden Markov model over word codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptmill.llm.common import REMEMBERED_WORDS, columns, counters, raw_texts, remainder, written

STATES = 8
ROUNDS = 3
# The most frequent words have an emission each; all others share one per class of endings.
OWN_CODES = 8192
ENDINGS = 2048
# Words whose counts the tasks hold (4 MB); counts of the others come by a join.
KNOWN_WORDS = 1 << 18
# Words whose neighbours start the states off.
SEED_WORDS = 256
# Tokens times documents worked on at once.
CELLS = 1 << 18
END = 0  # hash of the end token; no word gets it
END_CODE = OWN_CODES + ENDINGS
PAD = END_CODE + 1
CODES = END_CODE + 1
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
EDGE = b""".,;:!?"'()"""


class WordTable(dict):
    """Number of each word seen, with its hash and the class of its ending."""

    def __init__(self) -> None:
        self.hashes, self.endings = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int16)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        if at == self.hashes.size:
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
            self.endings = np.concatenate([self.endings, np.empty_like(self.endings)])
        self.hashes[at] = (xxhash.xxh3_64_intdigest(word) >> 1) + 1
        self.endings[at] = xxhash.xxh3_64_intdigest(word.rstrip(EDGE)[-4:]) % ENDINGS
        return at

    def of(self, text: bytes) -> np.ndarray:
        found = text.translate(LOWER).split()
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def word_counts(docs: DataFrame) -> DataFrame:
    """(hash, ending, n) of the tokens of all texts; each text ends with the end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordTable()
        sums, texts = np.zeros(1 << 16, np.int64), 0

        def flush() -> pa.RecordBatch:
            size = len(memory)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(memory.hashes[:size].copy()), pa.array(memory.endings[:size].copy()), pa.array(sums[:size].copy())],
                names=["hash", "ending", "n"],
            )
            memory.clear()
            sums[:] = 0
            return batch

        for batch in batches:
            for text in raw_texts(batch.column(0)):
                if len(memory) > REMEMBERED_WORDS:
                    yield flush()
                ids = memory.of(text)
                if len(memory) > sums.size:
                    sums = np.concatenate([sums, np.zeros(max(sums.size, len(memory) - sums.size), np.int64)])
                np.add.at(sums, ids, 1)
                texts += 1
        yield flush()
        if texts:
            yield pa.RecordBatch.from_pydict({"hash": [END], "ending": pa.array([-1], pa.int16()), "n": [texts]})

    parts = docs.select("text").mapInArrow(run, "hash bigint, ending smallint, n bigint")
    return parts.groupBy("hash").agg(F.max("ending").alias("ending"), F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What tasks need to know of the words: frequent ones in full, the others by class."""

    tokens: int
    distinct: int
    known: np.ndarray  # hashes in order
    known_n: np.ndarray
    known_code: np.ndarray  # own code, or -1
    class_n: np.ndarray
    class_words: np.ndarray

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 1.0) / (self.tokens + self.distinct + 1.0))


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, counts and endings of the most frequent words, at most ``most`` of them, in that order.

    Words are counted by 16 classes for each doubling of their count, so the least count
    that leaves few enough is known before any word reaches the driver.
    """
    level = F.floor(16 * F.log2("n")).cast("int")
    sizes = columns(counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")))
    order = np.argsort(-sizes["level"])
    fits = np.cumsum(sizes["words"][order]) <= most
    least = int(sizes["level"][order][fits][-1]) if fits.any() else 1 << 20
    top = columns(counts.where(level >= least))
    order = np.lexsort((top["hash"], -top["n"]))
    return top["hash"][order], top["n"][order], top["ending"][order].astype(np.int64)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The frequent words (a fixed number) and sums by class of endings of those without a code."""
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    hashes, n, endings = frequent(counts, KNOWN_WORDS)
    code = np.full(hashes.size, -1)
    own = np.flatnonzero(hashes != END)[:OWN_CODES]
    code[own] = np.arange(own.size)
    code[hashes == END] = END_CODE
    sums = counters(
        counts.where("ending >= 0").select("ending", "n", F.lit(1).alias("words")), "ending", "n", "words"
    )
    class_n, class_words = np.zeros(ENDINGS), np.zeros(ENDINGS)
    class_n[sums["ending"]], class_words[sums["ending"]] = sums["n"], sums["words"]
    np.subtract.at(class_n, endings[own], n[own].astype(float))
    np.subtract.at(class_words, endings[own], 1.0)
    order = np.argsort(hashes)
    return Vocabulary(
        int(total[0] or 0), int(total[1] or 0), hashes[order], n[order], code[order], class_n, class_words
    )


def encoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each row with its codes (16 bits a token), sums over its known words, and its other words.

    in_class sums log10 p(word | class of ending) = n / (class tokens + class words + 1) over
    words without a code; a word never seen gets what is left, (class words + 1) of it. Of the
    words looked up later only the divisor is in the sum.
    """
    model = docs.sparkSession.sparkContext.broadcast(vars(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, v = WordTable(), Vocabulary(**model.value)
        divisor = np.log10(v.class_n + v.class_words + 1)
        names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "in_class", "codes", "others"]

        def looked(hashes: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, ...]:
            """Of each word: whether its count is known, the count, its code, its shares of base and in_class."""
            at = np.searchsorted(v.known, hashes)
            at[at == v.known.size] = 0
            here = v.known[at] == hashes if v.known.size else np.zeros(hashes.size, bool)
            n = np.where(here, v.known_n[at], 0) if v.known.size else np.zeros(hashes.size)
            codes = np.where(here, v.known_code[at], -1) if v.known.size else np.full(hashes.size, -1)
            codes[hashes == END] = END_CODE
            here |= hashes == END
            by_class, endings = codes < 0, endings.astype(np.int64)
            base = np.where(here, v.base(n), 0.0)
            in_class = np.where(by_class, np.where(here, np.log10(np.maximum(n, 1)), 0.0) - divisor[endings], 0.0)
            return here, n > 0, np.where(by_class, OWN_CODES + endings, codes).astype(np.uint16), base, in_class

        end = looked(np.array([END]), np.array([0]))
        # Words are looked up once, when the memory first has them; a text only gathers.
        words, done = [np.empty(0, column.dtype) for column in end], 0
        for batch in batches:
            made = []
            for text in raw_texts(batch.column(3)):
                if len(memory) > REMEMBERED_WORDS:
                    memory.clear()
                    done = 0
                ids = memory.of(text)
                if len(memory) > done:
                    if len(memory) > words[0].size:
                        words = [np.concatenate([w, np.empty(memory.hashes.size - w.size, w.dtype)]) for w in words]
                    fresh = slice(done, len(memory))
                    for column, value in zip(words, looked(memory.hashes[fresh], memory.endings[fresh]), strict=True):
                        column[fresh] = value
                    done = len(memory)
                here, known, codes, base, in_class = (
                    np.append(column[ids], last) for column, last in zip(words, end, strict=True)
                )
                made.append(
                    (codes.size, int(known.sum()), float(base.sum()), float(in_class.sum()), codes.tobytes(),
                     memory.hashes[ids[~here[:-1]]])
                )
            columns = list(zip(*made, strict=True)) if made else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=names,
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(
        run,
        f"row bigint, doc_id {doc_id}, held_out boolean, n_tokens bigint, n_known bigint, base double, "
        "in_class double, codes binary, others array<bigint>",
    )


def looked_up(rows: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(row, base, in_class, n_known) of the words whose counts the tasks do not hold.

    Within its class a word counts as often as in training, one never seen once.
    """
    each = rows.select("row", F.explode("others").alias("hash"))
    n = F.coalesce("n", F.lit(0))
    return (
        each.join(counts.select("hash", "n"), "hash", "left")
        .groupBy("row")
        .agg(
            F.sum(F.log10((n + 1) / F.lit(float(vocabulary.tokens + vocabulary.distinct + 1)))).alias("base"),
            F.sum(F.log10(F.greatest(n, F.lit(1)))).alias("in_class"),
            F.sum((n > 0).cast("bigint")).alias("n_known"),
        )
    )


@dataclass
class Model:
    start: np.ndarray  # (states,)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (codes + 1, states); the last row is for places behind the end


def groups(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of like length, so many that rows times length stay within CELLS."""
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < order.size:
        step = max(1, CELLS // max(1, int(lengths[order[at]])))
        yield order[at : at + step]
        at += step


def padded(sequences: list[np.ndarray]) -> np.ndarray:
    """Codes by place and sequence."""
    table = np.full((max(s.size for s in sequences), len(sequences)), PAD, np.int64)
    for i, s in enumerate(sequences):
        table[: s.size, i] = s
    return table


def forward(codes: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward variables and the scale of each place."""
    places, n = codes.shape
    alpha, scale = np.empty((places, n, model.start.size)), np.empty((places, n))
    now = np.broadcast_to(model.start, (n, model.start.size))
    for t in range(places):
        now = now * model.emit[codes[t]]
        scale[t] = now.sum(axis=1)
        now = now / scale[t][:, None]
        alpha[t] = now
        now = now @ model.move
    return alpha, scale


def likelihood(codes: np.ndarray, model: Model) -> np.ndarray:
    """log10 of the probability of each sequence, by the scaled forward recursion."""
    now = np.broadcast_to(model.start, (codes.shape[1], model.start.size))
    total = np.zeros(codes.shape[1])
    for at in codes:
        now = now * model.emit[at]
        scale = now.sum(axis=1)
        total += np.log10(scale)
        now = (now / scale[:, None]) @ model.move
    return total


def expected_counts(codes: np.ndarray, model: Model, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
    """Add the expected counts of the sequences (Baum-Welch)."""
    alpha, scale = forward(codes, model)
    beta, steps = np.ones(alpha.shape[1:]), np.zeros_like(move)
    for t in range(codes.shape[0] - 1, -1, -1):
        gamma = alpha[t] * beta
        real = codes[t] != PAD
        gamma *= real[:, None]
        alpha[t] = gamma
        if t:
            ahead = model.emit[codes[t]] * beta / scale[t][:, None]
            steps += (alpha[t - 1] * real[:, None]).T @ ahead
            beta = ahead @ model.move.T
    move += steps * model.move
    start += alpha[0].sum(axis=0)
    flat = codes.ravel()
    for state in range(start.size):
        emit[:, state] += np.bincount(flat, weights=alpha[:, :, state].ravel(), minlength=CODES + 1)[:CODES]


def start_model(rows: DataFrame, states: int = STATES) -> Model:
    """States that begin as groups of frequent words with the same followers.

    Followers among the SEED_WORDS most frequent codes are counted over all training texts;
    the counts' singular vectors are grouped around words far from each other.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, single = np.zeros(SEED_WORDS**2, np.int64), np.zeros(CODES, np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                codes = np.frombuffer(value, np.uint16).astype(np.int64)
                both = (codes[:-1] < SEED_WORDS) & (codes[1:] < SEED_WORDS)
                np.add.at(pairs, codes[:-1][both] * SEED_WORDS + codes[1:][both], 1)
                np.add.at(single, codes, 1)
        for offset, sums in ((0, single), (CODES, pairs)):
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_pydict({"at": pa.array((some + offset).astype(np.int32)), "n": pa.array(sums[some])})

    sums = counters(rows.select("codes").mapInArrow(count, "at int, n bigint"), "at", "n")
    table = np.zeros(CODES + SEED_WORDS**2)
    table[sums["at"].astype(np.int64)] = sums["n"]
    unigram = (table[:CODES] + 1) / (table[:CODES].sum() + CODES)
    follow = np.sqrt(table[CODES:].reshape(SEED_WORDS, SEED_WORDS))
    follow /= np.maximum(np.linalg.norm(follow, axis=1, keepdims=True), 1e-9)
    left, size, _ = np.linalg.svd(follow)
    points = left[:, :states] * size[:states]
    centres = points[:1]
    for _ in range(states - 1):
        away = np.min(((points[:, None] - centres[None]) ** 2).sum(axis=2), axis=1)
        centres = np.vstack([centres, points[np.argmax(away)]])
    for _ in range(20):
        group = np.argmin(((points[:, None] - centres[None]) ** 2).sum(axis=2), axis=1)
        centres = np.array([points[group == k].mean(axis=0) if np.any(group == k) else centres[k] for k in range(states)])
    emit = np.repeat(unigram[:, None], states, axis=1)
    emit[:SEED_WORDS] *= 0.1
    emit[np.arange(SEED_WORDS), group] *= 10 * states * 0.9
    return normalised(np.ones(states), 0.9 * np.eye(states) + 0.1 / states, emit, unigram, 0)


def normalised(start: np.ndarray, move: np.ndarray, emit: np.ndarray, unigram: np.ndarray, weight: float) -> Model:
    """Probabilities from counts, smoothed by ``weight`` tokens of the unigram in each state."""
    emit = emit + weight * unigram[:, None]
    emit = emit / emit.sum(axis=0, keepdims=True)
    start, move = start + 0.1, move + 0.1 * (weight > 0)
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), np.vstack([emit, np.ones(start.size)]))


def train(rows: DataFrame, rounds: int = ROUNDS, states: int = STATES, smoothing: float = 200.0) -> Model:
    """Baum-Welch: each round adds up the expected counts of all partitions."""
    model = start_model(rows, states)
    unigram = model.emit[:CODES].mean(axis=1)
    values = [f"s{k}" for k in range(states)]
    for _ in range(rounds):
        now = rows.sparkSession.sparkContext.broadcast(vars(model))

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            at_hand = Model(**now.value)
            start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((CODES, states))
            for batch in batches:
                sequences = [np.frombuffer(v, np.uint16) for v in batch.column(0).to_pylist()]
                for part in groups(np.array([s.size for s in sequences])):
                    expected_counts(padded([sequences[i] for i in part]), at_hand, start, move, emit)
            some = np.flatnonzero(emit.sum(axis=1) > 0)
            table = np.vstack([start[None], move, emit[some]])
            at = np.concatenate([[-1 - states], np.arange(-states, 0), some]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), *map(pa.array, table.T)], names=["at", *values])

        parts = rows.select("codes").mapInArrow(run, "at int, " + ", ".join(f"{v} double" for v in values))
        sums = counters(parts, "at", *values)
        if not sums["at"].size:
            break
        table = np.zeros((1 + states + CODES, states))
        table[sums["at"].astype(np.int64) + 1 + states] = np.stack([sums[v] for v in values], axis=1)
        model = normalised(table[0], table[1 : 1 + states], table[1 + states :], unigram, smoothing)
    return model


def sequence_scores(rows: DataFrame, model: Model) -> DataFrame:
    """(row, path): log10 probability of the codes of each row."""
    known = rows.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_hand = Model(**known.value)
        for batch in batches:
            sequences = [np.frombuffer(v, np.uint16) for v in batch.column(batch.num_columns - 1).to_pylist()]
            total = np.zeros(len(sequences))
            for part in groups(np.array([s.size for s in sequences])):
                total[part] = likelihood(padded([sequences[i] for i in part]), at_hand)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(total)], names=[*batch.schema.names[:-1], "path"]
            )

    kept = [f for f in rows.schema.fields if f.name not in ("codes", "others")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return rows.select(*(f.name for f in kept), "codes").mapInArrow(run, f"{schema}, path double")


def score_texts(docs: DataFrame, rounds: int = ROUNDS, states: int = STATES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Words are lower-cased (A-Z); a text is its words and one end token. The model is a hidden
    Markov model: a state emits a frequent word, the class of endings of any other word, or
    the end; a word within its class follows its training count. Each word never seen counts as one
    token of its class, of which there is room for one more than the class has different words. score is the log10 of
    the exact probability (forward recursion over the codes plus the words in their classes),
    base_score that of single words with one added to each count.

    Held-out rows (crc32 of the id leaves 2 modulo 7) are scored only; a null id is not held
    out. Null and empty texts are the end token alone. Repeated rows are learned from and
    scored each. An empty table gives none.
    """
    held_out = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    counts = written(word_counts(docs.where(~F.col("held_out"))), "word-counts")
    words = vocabulary(counts)
    rows = written(encoded(docs, words), "encoded")
    model = train(rows.where(~F.col("held_out")), rounds, states)
    scored = sequence_scores(rows, model)
    others = looked_up(rows, counts, words).select(
        "row", F.col("base").alias("_base"), F.col("in_class").alias("_in_class"), F.col("n_known").alias("_known")
    )
    zero = F.lit(0.0)
    return scored.join(others, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", zero)).alias("base_score"),
        (F.col("path") + F.col("in_class") + F.coalesce("_in_class", zero)).alias("score"),
    )
