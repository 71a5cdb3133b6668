"""Operator 8. Mixing sources to target weights, in blocks of words. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptmill.llm.common import word_count, words, written
from conceptmill.llm.sharding import PRIME, identity

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
BLOCK_WORDS = 64
SHARDS = 16
ROUNDS = 12
SEED = 42
# Slots made from one row.
SLOTS_AT_ONCE = 16_384


def _mixed(x: Column, key: Column | int) -> Column:
    """A number below the prime that looks random, from a number and a key, in 64-bit steps."""
    x = (x.cast("bigint") % PRIME * 48271 + key) % PRIME
    x = (x * x + 12345) % PRIME
    return (x * 69621 + key) % PRIME


def source_targets(docs: DataFrame) -> DataFrame:
    """(source, rank, source_size, weight, target): words to take from each source.

    ``docs`` has source and size. Sources are a list of names, one row each; ranked by code
    point, null last, they weigh 5, 2, 1 in turn and share 150 % of all words. A target stops
    at twice its source; what is over goes to the others by weight. Sorted by the share at
    which each stops, a source is full if its limit is below what is left for its weight; the first that is not
    sets the level for all that are not.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    ranked = sizes.withColumn("rank", (F.row_number().over(by_name) - 1).cast("bigint")).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    )
    filled = Window.partitionBy(F.lit(0)).orderBy(F.col("limit") / F.col("weight"), "rank")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    rest = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = (F.col("wanted") - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(rest)
    return (
        ranked.withColumn("limit", LIMIT * F.col("source_size"))
        .withColumn("wanted", SHARE * F.sum("source_size").over(everything))
        .withColumn("level", level)
        .withColumn("open", F.col("limit") / F.col("weight") > F.col("level"))
        .withColumn("level", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("open"), F.least(F.col("level") * F.col("weight"), F.col("limit").cast("double"))).otherwise(
                F.col("limit").cast("double")
            ),
        )
        .select("source", "rank", "source_size", "weight", "target")
    )


def _written_targets(sized: DataFrame) -> DataFrame:
    """``source_targets`` as a table of one row a source, since places and draws ask for it several times."""
    return written(source_targets(sized), "mix-targets")


def word_offsets(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of ``docs`` (with uid and size) with rank, source_size, target and the place of their first word.

    The words of a source stand in a row in the order of the md5 of the rows' identity.
    Sums by range of the md5 and sums inside a range give the place, so a source may hold
    any share of the rows.
    """
    cut = docs.withColumn("_digest", F.md5("uid")).withColumn("_range", F.substring("_digest", 1, 3))
    keyed = cut.join(targets.drop("weight"), cut["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    before = Window.partitionBy("rank").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("rank", "_range")
        .agg(F.sum("size").alias("_size"))
        .select("rank", "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = (
        Window.partitionBy("rank", "_range").orderBy("_digest", "uid").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        keyed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["rank", "_range"])
        .withColumn("first_word", F.col("_start") + F.col("_inside"))
        .drop("_digest", "_range", "_inside", "_start")
    )


def shard_draws(targets: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(rank, shard, n_blocks, n_slots): blocks each output shard takes from each source.

    Every shard gets the whole part of its expected number of blocks; what is left over in
    a shard is drawn from the multinomial over the fractions (residual draws), by one
    pseudorandom number per draw.
    """
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    quota = targets.where("source_size > 0").select(
        "rank",
        blocks.alias("n_blocks"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        (F.col("target") / F.col("source_size") * blocks / shards).alias("expected"),
    )
    in_shard = Window.partitionBy("shard")
    upto = in_shard.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    quota = (
        quota.withColumn("whole", F.floor("expected"))
        .withColumn("fraction", F.col("expected") - F.col("whole"))
        .withColumn("left_over", F.round(F.sum("fraction").over(in_shard)).cast("int"))
        .withColumn("high", F.sum("fraction").over(upto) / F.sum("fraction").over(in_shard))
        .withColumn("low", F.coalesce(F.lag("high").over(in_shard.orderBy("rank")), F.lit(0.0)))
    )
    draws = (
        quota.select("shard", "left_over")
        .distinct()
        .where("left_over > 0")
        .select("shard", F.explode(F.sequence(F.lit(1), F.col("left_over"))).alias("draw"))
        .withColumn("u", _mixed(F.col("shard").cast("bigint") * 1_000_003 + F.col("draw"), seed) / PRIME)
    )
    drawn = (
        quota.select("shard", "rank", "low", "high")
        .join(draws, "shard")
        .where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
        .groupBy("shard", "rank")
        .agg(F.count(F.lit(1)).alias("n_drawn"))
    )
    return quota.join(drawn, ["shard", "rank"], "left").select(
        "rank",
        "shard",
        "n_blocks",
        (F.col("whole") + F.coalesce("n_drawn", F.lit(0))).alias("n_slots"),
    )


def taken_blocks(draws: DataFrame, seed: int = SEED, rounds: int = ROUNDS) -> DataFrame:
    """(rank, block, epoch, shard): the block that stands in each slot.

    Slots of a source are counted through over the shards. Slot j of a pass over the n
    blocks of its source goes through a swap-or-not permutation of 0..n-1 keyed by source
    and pass: each round pairs x with key - x mod n and a pseudorandom bit of the larger
    decides for both whether they swap. A source is passed over twice at most.
    """
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    tasks = int(draws.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = F.lit(SLOTS_AT_ONCE).cast("bigint")
    ranges = (
        draws.withColumn("from", F.coalesce(F.sum("n_slots").over(before), F.lit(0)))
        .where("n_slots > 0")
        .withColumn("chunk", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n_slots") - 1, step)))
        .withColumn("to", F.least(F.col("chunk") + SLOTS_AT_ONCE, F.col("from") + F.col("n_slots")) - 1)
        # A number of tasks, as these few small rows become all slots: left to itself Spark would put them together.
        .repartition(tasks, "rank", "chunk")
    )
    slots = (
        ranges.withColumn("slot", F.explode(F.sequence("chunk", "to")))
        .where(F.col("slot") < LIMIT * F.col("n_blocks"))
        .withColumn("epoch", F.floor(F.col("slot") / F.col("n_blocks")))
        .withColumn("block", F.col("slot") % F.col("n_blocks"))
    )
    # One projection after the other, so that each value is computed once.
    for i in range(rounds):
        slots = (
            slots.withColumn("_key", _mixed(F.col("rank") * 1_000_003 + i * 7919, seed) + F.col("epoch") * 104_729)
            .withColumn("_pair", F.pmod(F.col("_key") - F.col("block"), F.col("n_blocks")))
            .withColumn("_bit", _mixed(F.greatest("block", "_pair") + F.col("_key"), seed) % 2)
            .withColumn("block", F.when(F.col("_bit") == 1, F.col("_pair")).otherwise(F.col("block")))
        )
    # As a table, since what a join asks of the block would be pushed down and written out through all rounds.
    return written(slots.select("rank", "block", "epoch", "shard"), "mix-slots")


def _overlaps(placed: DataFrame) -> DataFrame:
    """A row for each block that a document with words has a share in."""
    last = F.col("first_word") + F.col("size") - 1
    ids = [F.floor(F.col("first_word") / BLOCK_WORDS), F.floor(last / BLOCK_WORDS)]
    return (
        placed.where("size > 0")
        .withColumn("block", F.explode(F.sequence(*ids)))
        .withColumn("_from", F.greatest(F.col("block") * BLOCK_WORDS, F.col("first_word")))
        .withColumn("_to", F.least((F.col("block") + 1) * BLOCK_WORDS - 1, last))
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): a row for each row of ``docs``.

    taken: words of the document that the mix takes, repeats counted. Words of a source
    are packed into blocks of 64; an output shard takes blocks, not documents, so a document
    may be taken in part, once or twice, never more often.

    A null or empty text has size 0 and is not taken; a null source is a source of its own.
    Rows that repeat id and text stand beside each other. An empty table gives none. Other
    columns are ignored.
    """
    sized = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), identity(docs).alias("uid")), "mix-sizes"
    )
    targets = _written_targets(sized)
    placed = word_offsets(sized, targets)
    times = taken_blocks(shard_draws(targets)).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    keep = ["doc_id", "source", "size", "source_size", "target"]
    # The blocks grow with the corpus, though their plan looks small: joined by sorting, never by broadcast.
    taken = (
        _overlaps(placed)
        .join(times.hint("merge"), ["rank", "block"], "left")
        .groupBy("rank", "first_word")
        .agg(
            *(F.first(c).alias(c) for c in keep),
            F.sum((F.col("_to") - F.col("_from") + 1) * F.coalesce("times", F.lit(0))).alias("taken"),
        )
        .select(*keep, "taken")
    )
    return taken.unionByName(placed.where("size = 0").select(*keep, F.lit(0).cast("bigint").alias("taken")))


def mixed_texts(docs: DataFrame) -> DataFrame:
    """The mix as documents: all columns of ``docs``, a row for each pass that takes words of a document.

    A pass that takes all words keeps the text as it is; otherwise the words taken are
    joined by spaces, in order. n_chars, where there is one, is counted anew.
    """
    numbered = written(
        docs.select(
            F.struct(*(docs[c] for c in docs.columns)).alias("doc"),
            "source",
            word_count(F.col("text")).alias("size"),
            identity(docs).alias("uid"),
            F.monotonically_increasing_id().alias("row"),  # read from the table, so it stays as it is
        ),
        "mix-documents",
    )
    sized = numbered.select("row", "source", "size", "uid")
    targets = _written_targets(sized)
    placed = word_offsets(sized, targets)
    taken = F.struct(
        (F.col("_from") - F.col("first_word")).alias("at"), (F.col("_to") - F.col("_from") + 1).alias("n")
    )
    picks = (
        _overlaps(placed.select("row", "rank", "first_word", "size"))
        .join(taken_blocks(shard_draws(targets)).hint("merge"), ["rank", "block"])
        .groupBy("row", "epoch")
        .agg(F.sort_array(F.collect_list(taken)).alias("picks"), F.sum(taken["n"]).alias("n_taken"))
    )
    joined = numbered.join(picks.hint("merge"), "row")
    parts = F.transform("picks", lambda p: F.slice(F.col("_words"), (p["at"] + 1).cast("int"), p["n"].cast("int")))
    whole = F.col("n_taken") == F.col("size")
    mixed = joined.withColumn("_words", F.when(~whole, words(F.col("doc.text")))).withColumn(
        "_text", F.when(whole, F.col("doc.text")).otherwise(F.array_join(F.flatten(parts), " "))
    )
    doc = F.col("doc").withField("text", F.col("_text"))
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.length("_text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(doc.alias("doc")).select("doc.*")
