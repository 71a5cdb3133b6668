"""Building blocks that keep hot keys from ending up in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptmill.session import ensure_checkpoint_dir

RANK_DIGITS = 4
# Hot keys that are looked for, at most; counters of the sketch that finds them (its counts are at most
# 3.5 / TRACKED of all rows too low); partitions a key has to fill to be hot.
MAX_HOT, TRACKED, HOT = 1000, 16_384, 2


def hot_keys(rows: DataFrame, on: Sequence[str], parts: int | None = None) -> DataFrame:
    """(_key, _salts) of the keys that need more than one shuffle partition; at most MAX_HOT rows.

    A frequent-items sketch, filled where the rows are and merged, sees every row once and
    keeps TRACKED counters, whatever the number of keys. A key is hot when it has HOT
    times the rows of an average partition and a thousandth of all rows at least; it is then cut
    into as many salts as it fills partitions. Keys are compared by their 64-bit hash: a cold
    key that shares the hash of a hot one is salted like it, on both sides.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = rows.select(F.xxhash64(*on).alias("_key"))
    seen = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_key, {MAX_HOT}, {TRACKED})").alias("items"))
    filled = F.col("count") * parts / F.col("n")
    return (
        seen.select("n", F.inline("items"))
        .where((filled > HOT) & (F.col("count") * MAX_HOT >= F.col("n")))
        .select(F.col("item").alias("_key"), F.least(F.ceil(filled), F.lit(parts)).cast("int").alias("_salts"))
    )


def _with_salts(rows: DataFrame, hot: DataFrame, on: Sequence[str]) -> DataFrame:
    # The hot keys are MAX_HOT rows of two numbers at most, so every task may hold them.
    return rows.withColumn("_key", F.xxhash64(*on)).join(F.broadcast(hot), "_key", "left")


def salted_lookup(lookup: DataFrame, hot: DataFrame, on: Sequence[str]) -> DataFrame:
    """``lookup`` with ``_salt``: rows of hot keys once for each of their salts, all others once."""
    every = F.when(F.col("_salts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_salts") - 1))
    return _with_salts(lookup, hot, on).withColumn("_salt", F.explode(every)).drop("_key", "_salts")


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    spread: Sequence[str],
    parts: int | None = None,
) -> DataFrame:
    """Equi-join rows with hot keys to a lookup side that is small per key.

    Only the keys that ``hot_keys`` measures are split, by a hash of the ``spread`` columns over
    as many salts as they need, and only their lookup rows are repeated; all other keys join as
    they are. When the lookup side turns out small, AQE still turns this into a broadcast join.
    """
    hot = hot_keys(rows, on, parts)
    salt = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int"), F.lit(0))
    left = _with_salts(rows, hot, on).withColumn("_salt", salt)
    added = [] if how in ("left_semi", "left_anti") else [name for name in lookup.columns if name not in on]
    return left.join(salted_lookup(lookup, hot, on), [*on, "_salt"], how).select(*rows.columns, *added)


def hash_rank(rows: DataFrame, uid: str, groups: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Exact 1-based rank of each row within its group, in order of ``md5(uid)``.

    The order is random-like but repeatable. Each group is cut into 16^4 hash
    ranges: counts per range give the start rank of the range and a window
    numbers the rows inside it, so a group may hold any share of all rows.
    ``uid`` has to be unique within a group.
    """
    digest = F.md5(uid)
    cut = rows.withColumn("_digest", digest).withColumn(
        "_range", F.conv(F.substring(digest, 1, RANK_DIGITS), 16, 10).cast("int")
    )
    keys = [*groups, "_range"]
    before = (
        Window.partitionBy(*(groups or [F.lit(0)]))
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        cut.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy("_digest", uid))
    return (
        cut.withColumn("_inside", inside)
        .join(starts, keys)
        .withColumn(name, (F.col("_start") + F.col("_inside")).cast("bigint"))
        .drop("_digest", "_range", "_inside", "_start")
    )


def with_ordinal(rows: DataFrame, order: Sequence[str], group: str, name: str = "ord") -> DataFrame:
    """0-based position of each row within its group, from one distributed sort.

    Rows are range-sorted by (group, order); the position is the offset inside
    the sorted partition plus the sizes of the partitions before it, minus the
    position at which the group starts. The sorted rows are checkpointed, so
    the partition numbers stay the same for both uses.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    ordered = (
        rows.orderBy(group, *order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_mid", 33))
        .withColumn("_offset", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_mid")
        .checkpoint()
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        ordered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    )
    placed = ordered.join(sizes, "_part").withColumn("_place", F.col("_base") + F.col("_offset"))
    starts = placed.groupBy(group).agg(F.min("_place").alias("_first"))
    return (
        spread_join(placed, starts, [group], "inner", spread=["_place"])
        .withColumn(name, (F.col("_place") - F.col("_first")).cast("bigint"))
        .drop("_part", "_offset", "_base", "_place", "_first")
    )


def members_without(members: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``members`` that do not occur in ``excluded``.

    One aggregation instead of distinct + anti-join: both sides collapse to a
    row per key before the shuffle, whatever the share of a single key.
    """
    marked = members.select(key, F.lit(False).alias("_out")).unionByName(
        excluded.select(key, F.lit(True).alias("_out"))
    )
    return (
        marked.groupBy(key)
        .agg(F.bool_or("_out").alias("_out"), F.bool_or(~F.col("_out")).alias("_in"))
        .where(F.col("_in") & ~F.col("_out"))
        .select(key)
    )


def all_of(rows: DataFrame, keys: Sequence[str], conditions: Sequence[Column]) -> DataFrame:
    """Keys for which every condition holds on at least one row.

    Replaces a self-join per condition by one aggregation with map-side combine.
    """
    flags = [F.bool_or(c).alias(f"_c{i}") for i, c in enumerate(conditions)]
    held = F.lit(True)
    for i in range(len(conditions)):
        held = held & F.col(f"_c{i}")
    return rows.groupBy(*keys).agg(*flags).where(held).select(*keys)
