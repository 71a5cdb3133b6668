"""Operator 5. Exact Jaccard self-join of word n-gram sets with token-combination prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptmill.llm.common import WordHashes, bit_filter, may_hold, raw_texts, small_batches, written
from conceptmill.llm.components import stars

SHINGLE = 3
# Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 90
# Counters of the frequency sketch: 4 MB as classes, whatever the corpus.
SKETCH_BITS = 22
SKETCH_BLOCK = 1 << 12
# A token is frequent when its counter is this many times the mean and this much above it.
FREQUENT_TIMES, FREQUENT_ABOVE = 8, 64
# Sets up to this size index pairs of frequent tokens, larger ones index single tokens.
PAIRED_SIZE = 300
# Buckets up to this size are compared in full; in larger ones stars come first.
SMALL_BUCKET = 32
# Signatures that two linked sets share at least, where they are large enough.
LEVEL = 4
STAR_ROUNDS = 3
# Signatures of each set that link near copies before all signatures are looked at.
FEW = 8
FILTER_BITS = 26

MIX = np.uint64(0x9E3779B97F4A7C15)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * MIX
    return values ^ (values >> np.uint64(29))


def shingle_set(text: bytes, memory: WordHashes, n: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-grams of a text; of all its words when there are fewer."""
    hashes = memory.of(text.translate(LOWER).split())
    if not hashes.size:
        return hashes
    width = min(n, hashes.size)
    grams = np.full(hashes.size - width + 1, width, np.uint64)
    for at in range(width):
        grams = mixed(grams + hashes[at : at + grams.size])
    return np.unique(grams)


def identity_of(grams: np.ndarray) -> int:
    """63-bit name of a set: equal sets, and only they, share it."""
    return xxhash.xxh3_64_intdigest(grams.tobytes()) >> 1


def scan(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, set_id, n_shingles) of every row, and (block, counts) of each partition's sketch."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, sketch = WordHashes(), np.zeros(1 << SKETCH_BITS, np.uint32)
        low = np.uint64((1 << SKETCH_BITS) - 1)
        names = ["doc_id", "set_id", "n_shingles", "block", "counts"]
        id_type = None
        for batch in batches:
            ids, sizes = [], []
            for text in raw_texts(batch.column(1)):
                grams = shingle_set(text, memory, n)
                sizes.append(grams.size)
                ids.append(identity_of(grams) if grams.size else None)
                np.add.at(sketch, (grams & low).astype(np.int64), 1)
            rows = batch.num_rows
            id_type = batch.column(0).type
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
                names=names,
            )
        for block in range(sketch.size // SKETCH_BLOCK if id_type is not None else 0):
            counts = sketch[block * SKETCH_BLOCK : (block + 1) * SKETCH_BLOCK]
            if counts.any():
                kind = np.uint8 if counts.max() < 256 else np.uint32
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([block], pa.int32()), pa.array([counts.astype(kind).tobytes()], pa.binary())],
                    names=names,
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {doc_id}, set_id bigint, n_shingles bigint, block int, counts binary"
    )


def frequency_classes(scanned: DataFrame) -> tuple[np.ndarray, int]:
    """Class (about 8 times the binary logarithm) of each counter, and the first frequent class.

    Partition sketches are added up block by block as a stream, so no task holds more than
    the sketch itself. Tasks make the classes: one byte a counter reaches the driver, in one job.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kind = np.uint8 if len(counts) == SKETCH_BLOCK else np.uint32
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, kind).astype(np.int64)
        for block, counts in sums.items():
            of = np.minimum(255, np.round(8 * np.log2(counts.astype(float) + 1))).astype(np.uint8)
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([block], pa.int32()), "total": pa.array([int(counts.sum())], pa.int64()), "classes": pa.array([of.tobytes()], pa.binary())}
            )

    parts = scanned.where("block IS NOT NULL").select("block", "counts").repartition("block")
    found = parts.mapInArrow(add, "block int, total bigint, classes binary").toArrow()
    classes = np.zeros(1 << SKETCH_BITS, np.uint8)
    total = 0
    for block, counted, of in zip(*(found.column(name) for name in ("block", "total", "classes")), strict=True):
        at = block.as_py() * SKETCH_BLOCK
        classes[at : at + SKETCH_BLOCK] = np.frombuffer(of.as_buffer(), np.uint8)
        total += counted.as_py()
    limit = max(FREQUENT_TIMES * total / classes.size, total / classes.size + FREQUENT_ABOVE)
    return classes, int(min(255, np.ceil(8 * np.log2(limit + 1))))


def mismatches(size: int, percent: int = PERCENT) -> int:
    """Tokens of a set of this size that may be missing from a set it links with."""
    return size - -(-percent * size // 100)


def signatures(grams: np.ndarray, classes: np.ndarray, frequent: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, float]:
    """Signatures of a set, the place of the first token of each, and the mean class of its tokens.

    Tokens stand in the order of (class, hash), rare ones first. With m tokens that may be
    missing, m + LEVEL rare tokens as single signatures are enough for LEVEL to be shared. A
    set with fewer rare tokens takes them all and extends its prefix into the frequent
    ones until rare tokens plus frequent tokens less one are m + LEVEL; pairs of the
    frequent ones are signatures. Linked sets then share that many tokens and one more, and
    thus LEVEL signatures again, be they tokens or pairs. Sets above PAIRED_SIZE index
    single tokens only (pairs would grow with the square of the prefix); those close to
    that size do both, as the two ways do not meet.
    """
    of = classes[(grams & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
    weight = float(of.mean())
    order = np.lexsort((grams, of))
    ranked, rare = grams[order], int((of < frequent).sum())
    need = mismatches(grams.size, percent) + LEVEL
    made, places = [], []
    if 100 * grams.size > percent * PAIRED_SIZE:
        made.append(mixed(ranked[:need] + np.uint64(1)))
        places.append(np.arange(made[-1].size))
    if grams.size <= PAIRED_SIZE:
        made.append(mixed(ranked[: min(need, rare)] + np.uint64(2)))
        places.append(np.arange(made[-1].size))
        if rare < need:
            tail = ranked[rare : need + 1]
            first, second = np.triu_indices(tail.size, 1)
            made.append(mixed(mixed(tail[first] + np.uint64(3)) + tail[second]))
            places.append(rare + first)
    return np.concatenate(made), np.concatenate(places), weight


def index_sets(docs: DataFrame, classes: np.ndarray, frequent: int, n: int, percent: int) -> DataFrame:
    """(sig, set_id, size, weight, place): a row for each signature of each set."""
    known = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, done = WordHashes(), set()
        for batch in batches:
            parts: list[tuple[np.ndarray, int, int, float, np.ndarray]] = []
            for text in raw_texts(batch.column(0)):
                grams = shingle_set(text, memory, n)
                if grams.size < 2:
                    continue
                name = identity_of(grams)
                if name in done:
                    continue
                if len(done) > 200_000:
                    done.clear()
                done.add(name)
                found, places, weight = signatures(grams, known.value, frequent, percent)
                parts.append((found, name, grams.size, weight, places))
            if parts:
                lengths = [p[0].size for p in parts]
                yield pa.RecordBatch.from_pydict(
                    {
                        "sig": pa.array(np.concatenate([p[0] for p in parts]).view(np.int64)),
                        "set_id": pa.array(np.repeat(np.array([p[1] for p in parts], np.int64), lengths)),
                        "size": pa.array(np.repeat(np.array([p[2] for p in parts], np.int32), lengths)),
                        "weight": pa.array(np.repeat(np.array([p[3] for p in parts], np.float32), lengths)),
                        "place": pa.array(np.concatenate([p[4] for p in parts]).astype(np.int32)),
                    }
                )

    return docs.select("text").mapInArrow(run, "sig bigint, set_id bigint, size int, weight float, place int")


def sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(set_id, grams) once for each wanted set; a filter of fixed size keeps the others from being moved."""
    packed = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted, FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, done = WordHashes(), set()
        for batch in batches:
            names, sets = [], []
            for text in raw_texts(batch.column(0)):
                grams = shingle_set(text, memory, n)
                name = identity_of(grams) if grams.size else None
                if name is not None and name not in done and may_hold(packed.value, np.array([name], np.uint64))[0]:
                    if len(done) > 200_000:
                        done.clear()
                    done.add(name)
                    names.append(name)
                    sets.append(grams.tobytes())
            yield pa.RecordBatch.from_pydict({"set_id": pa.array(names, pa.int64()), "grams": pa.array(sets, pa.binary())})

    found = docs.select("text").mapInArrow(run, "set_id bigint, grams binary")
    return found.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.first("grams").alias("grams"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link, by their exact intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for first, second in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(first, np.uint64), np.frombuffer(second, np.uint64)
                shared = np.intersect1d(x, y, assume_unique=True).size
                keep.append(100 * shared >= percent * (x.size + y.size - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("set_id").alias("a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("set_id").alias("b"), F.col("grams").alias("grams_b"))
    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", "grams_a", "grams_b").mapInArrow(run, "a bigint, b bigint")
    )


def ends_of(pairs: DataFrame) -> DataFrame:
    """(set_id): both sets of every pair."""
    return pairs.select(F.explode(F.array("a", "b")).alias("set_id"))


def _near_in_size(percent: int) -> Column:
    return 100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")


def _may_link(percent: int) -> Column:
    """Sizes and places allow a link, if this is the first signature that both have.

    Before the first token that two sets share they share none, so what they share is at
    most what stands from there on. Links show this at their first common signature.
    """
    rest = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    return _near_in_size(percent) & ((100 + percent) * rest >= percent * (F.col("size_a") + F.col("size_b")))


def star_pairs(buckets: DataFrame, choice: Column, percent: int) -> DataFrame:
    """Every member of a bucket with the one member that ``choice`` puts first."""
    centre = buckets.groupBy("sig").agg(F.max_by(F.struct("set_id", "size", "part", "place"), choice).alias("c"))
    return (
        buckets.join(centre, "sig")
        .where("part <> c.part")
        .select(
            F.least("set_id", "c.set_id").alias("a"),
            F.greatest("set_id", "c.set_id").alias("b"),
            F.col("size").alias("size_a"),
            F.col("c.size").alias("size_b"),
            F.col("place").alias("place_a"),
            F.col("c.place").alias("place_b"),
        )
        .where(_may_link(percent))
        .select("a", "b")
        .distinct()
    )


def _required(size: str, percent: int) -> Column:
    """Signatures that a set of this size shares with any it links with, at least."""
    return F.greatest(F.lit(1), F.least(F.lit(LEVEL), F.ceil(F.col(size) * percent / 100).cast("int") - 1))


def counted_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs that meet in small buckets often enough.

    What a pair may share in large buckets, at most the large buckets of either, counts in its favour.
    """
    large = buckets.where(F.col("n_members") > SMALL_BUCKET).groupBy("set_id").agg(F.count(F.lit(1)).alias("n_large"))
    small = (
        buckets.where(F.col("n_members") <= SMALL_BUCKET)
        .join(large, "set_id", "left")
        .select("sig", "set_id", "size", "place", F.coalesce("n_large", F.lit(0)).cast("int").alias("n_large"))
    )
    names = ("set_id", "size", "place", "n_large")
    left, right = (small.select("sig", *(F.col(c).alias(f"{c}_{x}") for c in names)) for x in "ab")
    return (
        left.join(right, "sig")
        .where((F.col("set_id_a") < F.col("set_id_b")) & _near_in_size(percent))
        .withColumn(
            "needed",
            F.least(_required("size_a", percent), _required("size_b", percent)) - F.least("n_large_a", "n_large_b"),
        )
        .groupBy(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("needed").alias("needed"),
            F.bool_or(_may_link(percent) | (F.least("n_large_a", "n_large_b") > 0)).alias("may"),
        )
        .where("n >= needed AND may")
        .select("a", "b")
    )


def other_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """All pairs within a bucket that are not yet in one component."""
    names = {"set_id": "", "size": "size_", "place": "place_", "part": "part_"}
    left, right = (buckets.select("sig", *(F.col(c).alias(f"{n}{x}") for c, n in names.items())) for x in "ab")
    return (
        left.join(right, "sig")
        .where((F.col("a") < F.col("b")) & (F.col("part_a") != F.col("part_b")) & _may_link(percent))
        .select("a", "b")
        .distinct()
    )


def _parts(links: DataFrame) -> DataFrame:
    """(set_id, part): every set that links reach, but for the smallest of a part, which names it."""
    return stars(links).select(F.col("a").alias("set_id"), F.col("b").alias("part"))


def _nodes_and_parts(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, set_id, n_shingles) of every row, and the parts; both are written."""
    scanned = written(scan(docs, n), "shingles")
    nodes = scanned.where("block IS NULL").select("doc_id", "set_id", "n_shingles")
    classes, frequent = frequency_classes(scanned)
    index = written(index_sets(docs, classes, frequent, n, percent), "signatures")
    met = (
        index.groupBy("sig")
        .agg(F.min("set_id").alias("_low"), F.max("set_id").alias("_high"))
        .where("_low <> _high")
        .select("sig")
    )
    shared = written(index.join(met, "sig", "left_semi").distinct(), "shared-signatures")
    sizes = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("n_members"))
    shared = written(shared.join(sizes, "sig"), "buckets")
    large = shared.where(F.col("n_members") > SMALL_BUCKET)
    pairs = written(counted_pairs(shared, percent), "pairs")
    wanted = ends_of(pairs).unionByName(large.select("set_id")).distinct()
    sets = written(sets_of(docs, wanted, n), "sets")

    compared = pairs
    parts = _parts(written(verified(pairs, sets, percent), "links"))
    by_hash = Window.partitionBy("set_id").orderBy(F.xxhash64("sig"), "sig")
    few = written(large.withColumn("_nth", F.row_number().over(by_hash)).where(F.col("_nth") <= FEW).drop("_nth"), "few")
    buckets = None
    for step in range(-1, STAR_ROUNDS + 1):
        if buckets is None:  # else no link was found since
            # First by few signatures of each set, alike for alike sets: most near copies are in one part before all are looked at.
            every = (few if step < 0 else large).join(parts, "set_id", "left").withColumn("part", F.coalesce("part", "set_id"))
            several = (
                every.groupBy("sig").agg(F.min("part").alias("_low"), F.max("part").alias("_high")).where("_low <> _high")
            )
            buckets = written(every.join(several.select("sig"), "sig", "left_semi"), "open-buckets")
            if buckets.isEmpty():
                if step >= 0:
                    break
                buckets = None
                continue
            if step >= 0:
                large = buckets.drop("part")  # a bucket within one part stays so
        if step == STAR_ROUNDS:
            pairs = other_pairs(buckets, percent)
        else:
            first = F.struct("weight", "set_id")
            choice = first if step <= 0 else F.struct(F.xxhash64("set_id", F.lit(step)), F.col("set_id"))
            pairs = star_pairs(buckets, choice, percent)
        pairs = written(pairs.join(compared, ["a", "b"], "left_anti"), "pairs")
        if step < 0:
            buckets = None
        if pairs.isEmpty():
            continue
        compared = compared.unionByName(pairs)
        # A few pairs move a few sets, not all of them.
        asked = sets.join(ends_of(pairs), "set_id", "left_semi")
        found = written(verified(pairs, asked, percent), "links")
        if not found.isEmpty():
            # The parts so far stand for the links they came from.
            parts = _parts(found.unionByName(parts.select(F.col("set_id").alias("a"), F.col("part").alias("b"))))
            buckets = None
    return nodes, parts


def link_documents(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``.

    Documents with equal sets are one node. Nodes that share a signature form a bucket. Pairs
    that meet in small buckets as often as linked ones must are compared. In a large bucket
    all are compared with one member, the one with the most frequent tokens first, and
    links join nodes to parts; buckets within one part are done, so a group of near copies
    takes as many comparisons as it has members. Then, in large buckets that still hold
    several parts, every pair of different parts that has not been compared is.
    Pairs are verified by their whole sets. Parts are connected components.

    Words are lower-cased (A-Z). Fewer than n words are one n-gram; texts without words (or
    null) have none and link with nothing. component_id is the smallest doc_id that links
    reach; a null id is passed over unless all are null. Repeated rows are linked like
    copies. An empty table gives none. Other columns are ignored.
    """
    with small_batches(docs.sparkSession):
        nodes, parts = _nodes_and_parts(docs, n, percent)
    named = nodes.join(parts, "set_id", "left").withColumn("part", F.coalesce("part", "set_id"))
    least = named.where("part IS NOT NULL").groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "part", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def first_of_each(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each group that links reach, with all columns; rows without words all stay.

    It is the row with the smallest id, null last, and then with the smallest checksum of the text.
    Rows are told apart by id and text, so an id that stands on several texts, or none, is no
    reason to lose a row; of rows equal in both any one stays.
    """

    def digest(text: Column) -> Column:
        return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))

    key = F.struct(F.isnull("doc_id").alias("absent"), F.col("doc_id").alias("id"), digest(F.col("text")).alias("digest"))
    linked = link_documents(docs.select(key.alias("doc_id"), "text"), n, percent).where("n_shingles > 0")
    grouped = linked.groupBy("doc_id").agg(F.first("component_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    moved = written(
        grouped.where("doc_id <> first OR rows > 1").select("doc_id.id", "doc_id.digest", (F.col("doc_id") == F.col("first")).alias("stays")),
        "copies",
    )
    packed = docs.sparkSession.sparkContext.broadcast(bit_filter(moved.select(F.xxhash64("id", "digest").alias("name")), FILTER_BITS))

    @F.pandas_udf("boolean")
    def may_move(name: pd.Series) -> pd.Series:
        return pd.Series(may_hold(packed.value, name.to_numpy().view(np.uint64)))

    def at(listed: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(listed["id"]) & (digest(docs["text"]) == listed["digest"])

    # Rows that the filter does not know stay where they are; a join decides on the others.
    asked = may_move(F.xxhash64(docs["doc_id"], digest(docs["text"])))
    some = docs.where(asked)
    rest = docs.where(~asked).unionByName(some.join(moved, at(moved), "left_anti"))
    repeated = moved.where("stays")
    if repeated.isEmpty():
        return rest
    copies = some.join(repeated, at(repeated), "left_semi").select(F.struct(*docs.columns).alias("doc"))
    by_row = copies.groupBy(F.col("doc.doc_id").alias("id"), digest(F.col("doc.text")).alias("digest")).agg(F.first("doc").alias("doc"))
    return rest.unionByName(by_row.select("doc.*"))
