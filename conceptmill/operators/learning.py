"""Learning data: label ids, encodings and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.operators.labels import with_positions
from conceptmill.operators.skew import hash_rank, spread_join

TEST_SHARE_TENTHS = 1


def label_ids(codelist: DataFrame) -> DataFrame:
    """(scheme, label, id): the position in the codelist; of equal labels the last."""
    placed = codelist if "ord" in codelist.columns else with_positions(codelist)
    return placed.groupBy("scheme", "label").agg(F.max("ord").cast("bigint").alias("id"))


def problem_type(labelled: DataFrame) -> DataFrame:
    """One row with the problem type: multi-label as soon as a row has several classes."""
    several = F.coalesce(F.bool_or(F.size("classes") > 1), F.lit(False))
    return labelled.agg(
        F.when(several, F.lit(v.MULTI_LABEL)).otherwise(F.lit(v.SINGLE_LABEL)).alias("problem_type")
    )


def check_problem_type(name: str) -> str:
    if name not in (v.SINGLE_LABEL, v.MULTI_LABEL):
        raise ValueError(f"unknown problem type: {name}")
    return name


def unknown_classes(labelled: DataFrame, ids: DataFrame) -> DataFrame:
    """(decision, label) of classes that are not in the codelist: the reject table."""
    given = labelled.select("decision", F.explode("classes").alias("label")).distinct()
    known = ids.select("label").distinct()
    return spread_join(given, known, ["label"], "left_anti", spread=["decision"])


def single_label_ids(labelled: DataFrame, ids: DataFrame) -> DataFrame:
    """(decision, label, id) with the id of the first class; unknown classes drop out.

    Rows dropped here are those ``unknown_classes`` reports.
    """
    first = labelled.where(F.size("classes") > 0).select("decision", F.get("classes", F.lit(0)).alias("label"))
    return spread_join(first, ids.select("label", "id"), ["label"], "inner", spread=["decision"]).select(
        "decision", "label", "id"
    )


def multi_hot(labelled: DataFrame, ids: DataFrame, *, size: int | None = None) -> DataFrame:
    """(decision, target): a 0/1 vector with one place per distinct label of the codelist.

    ``labelled`` has one row per decision. Decisions with an unknown class drop
    out, see ``unknown_classes``. ``size`` sets another vector length.
    """
    width = ids.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar() if size is None else F.lit(size)
    given = labelled.select("decision", F.explode("classes").alias("label"))
    found = spread_join(given, ids.select("label", "id"), ["label"], "left", spread=["decision"])
    grouped = found.groupBy("decision").agg(
        F.collect_set(F.col("id").cast("int")).alias("ids"), F.bool_and(F.col("id").isNotNull()).alias("known")
    )
    places = F.sequence(F.lit(0), F.col("n") - 1)
    return (
        grouped.where("known")
        .withColumn("n", width)
        .select("decision", F.transform(places, lambda i: F.array_contains("ids", i).cast("double")).alias("target"))
    )


def split_global(decisions: DataFrame) -> DataFrame:
    """(decision, split): a tenth of the distinct decisions, rounded up, is the test set."""
    ranked = hash_rank(decisions.select("decision").distinct(), "decision")
    total = decisions.select(F.count_distinct("decision").alias("n")).scalar()
    return ranked.withColumn("total", total).select(
        "decision",
        F.when(F.col("rank") <= F.expr(f"(total * {TEST_SHARE_TENTHS} + 9) div 10"), F.lit("test"))
        .otherwise(F.lit("train"))
        .alias("split"),
    )


def stratified_quotas(labelled: DataFrame) -> DataFrame:
    """(id, n, quota, possible): how many decisions of each label go to the test set.

    Shares are rounded down; what is missing to the tenth of all goes to the
    labels with the largest remainders. One row per label of the codelist.
    """
    counts = labelled.select("decision", "id").distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(0))
    # Counts multiply beyond 64 bits when there are billions of decisions.
    wide = "CAST(test AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0))"
    labels = F.count(F.lit(1)).over(whole)
    shares = (
        counts.withColumn("total", F.sum("n").over(whole))
        .withColumn("test", F.expr(f"(total * {TEST_SHARE_TENTHS} + 9) div 10"))
        .withColumn("down", F.expr(f"{wide} div total"))
        .withColumn("left", F.expr(f"{wide} % total"))
        .withColumn("missing", F.col("test") - F.sum("down").over(whole))
        .withColumn("place", F.row_number().over(whole.orderBy(F.desc("left"), "id")))
        # The conditions under which a stratified split can exist.
        .withColumn(
            "possible",
            (F.min("n").over(whole) >= 2) & (F.col("test") >= labels) & (F.col("total") - F.col("test") >= labels),
        )
    )
    extra = (F.col("place") <= F.col("missing")).cast("bigint")
    return shares.select("id", "n", (F.col("down") + extra).alias("quota"), "possible")


def split_stratified(labelled: DataFrame) -> DataFrame:
    """(decision, id, split) with the test tenth spread over the labels.

    Falls back to ``split_global`` when some label is too small to stratify.
    """
    decisions = labelled.select("decision", "id").distinct()
    quotas = stratified_quotas(decisions)
    possible = quotas.agg(F.bool_and("possible").alias("possible")).first()["possible"]
    if not possible:
        return decisions.join(split_global(decisions), "decision").select("decision", "id", "split")
    ranked = hash_rank(decisions, "decision", ["id"])
    limits = quotas.select("id", "quota")
    judged = spread_join(ranked, limits, ["id"], "inner", spread=["decision"])
    return judged.select(
        "decision", "id", F.when(F.col("rank") <= F.col("quota"), F.lit("test")).otherwise(F.lit("train")).alias("split")
    )
