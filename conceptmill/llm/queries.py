"""Registered queries of the operators and their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptmill.llm import (
    checks, conversations, decontamination, language_id, licenses, lm_scoring, mixing, ngram_join, pii, quality_rules,
    resampling, sharding, token_counts, toxicity,
)
from conceptmill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(check: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if check is not None:
            SQL[fn.__name__] = check
        return fn

    return register


@query()
def op1_lm_scoring(spark, sf):
    return lm_scoring.score_texts(table(spark, sf, "documents"))


@query()
def op2_pii(spark, sf):
    found = pii.find_personal_data(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["in_base"])
    counts = [pii.number_of(base, kind).alias(f"n_{kind}") for kind in pii.KINDS[:4]]
    return found.select(
        "doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans")
    )


@query()
def op3_quality_rules(spark, sf):
    return quality_rules.score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query()
def op4_toxicity(spark, sf):
    return toxicity.score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query()
def op5_ngram_join(spark, sf):
    return ngram_join.link_documents(table(spark, sf, "documents"))


@query()
def op6_sharding(spark, sf):
    sharded = sharding.shard_documents(table(spark, sf, "documents").select("doc_id", "text"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query()
def op7_token_counts(spark, sf):
    return token_counts.length_histogram(table(spark, sf, "documents"))


@query()
def op8_mixing(spark, sf):
    mixed = mixing.mix_documents(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op9_decontamination(spark, sf):
    return decontamination.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query()
def op10_language_id(spark, sf):
    return language_id.identify_languages(table(spark, sf, "documents"))


@query(checks.CONVERSATIONS)
def op11_conversation_repair(spark, sf):
    turns = table(spark, sf, "conversations")
    return conversations.repair_conversations(conversations.damaged(turns), turns.select("conv_id"))


@query(checks.LICENSES)
def op12_license_scans(spark, sf):
    found = licenses.find_licenses(table(spark, sf, "documents"))
    joined = [F.array_join(c, ",").alias(name) for c, name in (("base", "base_labels"), ("labels", "labels"))]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score")


@query(checks.RESAMPLING)
def op13_resampling(spark, sf):
    return resampling.draw_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
