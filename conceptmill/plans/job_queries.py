"""Named queries that write tables, run whole jobs or streams."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.operators import model_calls as calls
from conceptmill.operators import writes as wr
from conceptmill.operators.worklist import Worklist
from conceptmill.plans import bridge as br
from conceptmill.plans import checks as sql
from conceptmill.plans import jobs, stubs
from conceptmill.plans.catalog import _LABELLED, query
from conceptmill.session import scratch_path
from conceptmill.sources import quads as src
from conceptmill.sources import results_json
from conceptmill.streaming import incremental as inc

_FLAT = ["g", "s", "p", "o.value AS o", "o.kind AS kind", "coalesce(o.lang, '') AS lang"]


def _no_prompts(spark):
    return spark.createDataFrame([], "scheme string, system_message string, user_message string")


# --- stored tables ------------------------------------------------------------


@query(sql.ALL_DOC_QUADS)
def quad_roundtrip(spark, sf):
    path = scratch_path(spark, "roundtrip")
    src.write_quads(br.quads(spark, sf, "docs", "concepts"), path)
    return src.read_quads(spark, path).selectExpr(*_FLAT)


@query(sql.ALL_DOC_QUADS)
def quad_append(spark, sf):
    path = scratch_path(spark, "append")
    quads = br.quads(spark, sf, "docs", "concepts")
    src.write_quads(quads.where(F.col("g") != br.DECISIONS), path)
    src.append_quads(quads, path)
    src.append_quads(quads.where(F.col("g") == br.DECISIONS), path)
    return src.read_quads(spark, path).selectExpr(*_FLAT)


@query(sql.ALL_DOC_QUADS)
def nquads_roundtrip(spark, sf):
    path = scratch_path(spark, "nquads")
    src.write_nquads(br.quads(spark, sf, "docs", "concepts"), path)
    return src.read_nquads(spark, path).selectExpr(*_FLAT)


@query(sql.GRAPH_WIPE)
def graph_wipe(spark, sf):
    path = scratch_path(spark, "wiped")
    src.write_quads(src.without_graphs(br.quads(spark, sf, "docs", "anns"), [br.MIRROR, br.AI]), path)
    return src.read_quads(spark, path).groupBy("g", "p").agg(F.count("s").alias("n"))


@query(sql.RESULTS_JSON)
def results_json_scan(spark, sf):
    path = scratch_path(spark, "results")
    docs = br.table(spark, sf, "documents").selectExpr(
        "CAST(doc_id AS STRING) AS doc", "text", "CASE WHEN doc_id % 3 <> 0 THEN source END AS title",
        "doc_id div 50 AS page",
    )
    results_json.results_documents(docs, "page").write.text(path)
    return results_json.read_results(spark, path, ["doc", "text", "title"], one_per_line=True)


@query(sql.unannotated(sql.DEFAULT_TARGETS, sql.IN_DECISIONS))
def worklist_after_delta(spark, sf):
    """A worklist of an older store, brought up to date by what has come and gone since."""
    quads = br.quads(spark, sf, *_LABELLED)
    matters = F.col("p").isin(v.TYPE, v.MOTIVATED_BY, v.HAS_BODY, v.HAS_TARGET)
    late = matters & (F.substring(F.md5(F.concat("s", "p")), 1, 1) < "4")
    gone = quads.where(matters).withColumn("s", F.concat("s", F.lit("/gone")))
    work = Worklist(scratch_path(spark, "worklist"), br.QUALITY, br.DECISIONS)
    work.rebuild(quads.where(~late).unionByName(gone))
    work.update(quads.where(late), gone)
    return work.open_decisions(spark)


# --- jobs ---------------------------------------------------------------------


@query(sql.BATCH_MODEL)
def batch_model_annotation(spark, sf):
    result = jobs.batch_model_annotation(
        br.quads(spark, sf, *_LABELLED, "task"), br.TASK, factory=stubs.chat_factory, prompts=_no_prompts(spark),
        pause_seconds=0, on_failure="quarantine",
    )
    return result.quads().select("g", "s", "p", F.col("o.value").alias("o"))


def _label_documents(spark, sf, factory=stubs.chat_factory, **options):
    texts = br.table(spark, sf, "documents").selectExpr(f"{br.DOC} AS decision", "text")
    codelist = jobs.stored_codelist(br.quads(spark, sf, "concepts"), br.QUALITY)
    return jobs.label_decisions(
        texts, codelist, br.QUALITY, task=br.TASK, factory=factory, prompts=_no_prompts(spark),
        pause_seconds=0, on_failure="quarantine", **options,
    )


@query(sql.FAILED_REPLIES)
def failed_replies(spark, sf):
    return _label_documents(spark, sf, attempts=2).failed.select("id", "raw", F.isnotnull("parse_error").alias("refused"))


@query(sql.THIRD_ROUND)
def replies_third_round(spark, sf):
    """Some prompts fail in the first round, others in the first two; the third model answers what is left."""
    models = [stubs.broken_factory, stubs.chat_factory, stubs.patient_factory]
    result = _label_documents(spark, sf, factory=models, max_callers=3, calls_per_second=100_000)
    return result.annotations.select("target", "body")


@query(sql.SEND_SLOTS)
def send_slots(spark, sf):
    requests = br.table(spark, sf, "documents").selectExpr(f"{br.DOC} AS id")
    return calls.send_slots(requests, callers=7, rate=50.0)


@query(sql.NEW_ONLY)
def job_annotations_new_only(spark, sf):
    made = _label_documents(spark, sf).annotations
    stored = made.where("substr(md5(target), 1, 1) < '8'").select(*wr.ANNOTATION_KEY)
    return _label_documents(spark, sf, existing=stored).annotations


@query(sql.JOB_REPORT)
def skipped_and_unresolved(spark, sf):
    result = _label_documents(spark, sf)
    skipped = result.skipped.select("decision", F.lit("skipped").alias("kind"), F.col("skip_reason").alias("detail"))
    return skipped.unionByName(
        result.unresolved.select("decision", F.lit("unresolved").alias("kind"), F.col("label").alias("detail"))
    )


@query(sql.RANDOM_JOB)
def random_label_annotation(spark, sf):
    quads = br.quads(spark, sf, *_LABELLED, "task")
    return jobs.batch_model_annotation(quads, br.TASK, factory=None, prompts=_no_prompts(spark)).annotations


@query(sql.SCORED_JOB)
def scored_annotation(spark, sf):
    quads = br.quads(spark, sf, *_LABELLED, "task")
    return jobs.classifier_annotation_with(
        quads, br.TASK, stubs.scorer_factory, stubs.LABELS, v.MULTI_LABEL
    ).annotations


@query(sql.IMPACT_JOB)
def impact_job(spark, sf):
    quads = br.quads(spark, sf, *_LABELLED, "task", "inputs")
    result = jobs.impact_assessment(quads, br.IMPACT_TASK, factory=stubs.impact_factory, on_failure="quarantine")
    stored = result.quads.unionByName(wr.container_quads(result.containers))
    return stored.select("g", "s", "p", F.col("o.value").alias("o"))


_ABOUT = jobs.ModelAbout(
    "demo/trained", "c0ffee", "f00d", "http://ex/repo", "http://ex/repo/tree/main/", "http://ex/code",
    datetime.datetime(2024, 3, 1, 9, 30),
)


def _trained(spark, sf):
    quads = br.quads(spark, sf, *_LABELLED, "task")
    return quads, jobs.train_classifier(quads, br.TASK, about=_ABOUT)


@query(sql.TRAINING_FACTS)
def training_facts(spark, sf):
    """What is known of a training before it is done."""
    training = _trained(spark, sf)[1]
    facts = [training.examples.groupBy(F.col("split").alias("name")).agg(F.count(F.lit(1)).alias("value"))]
    facts.append(training.judged.select(F.lit("judged").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("value")))
    facts.append(training.rejected.agg(F.lit("rejected").alias("name"), F.count(F.lit(1)).alias("value")))
    shares = F.array(*training.metrics.columns)
    within = F.size(F.filter(shares, lambda x: (x >= 0) & (x <= 1))).cast("bigint")
    facts.append(training.metrics.select(F.lit("measures from 0 to 1").alias("name"), within.alias("value")))
    lines = F.size(F.split("report", "\n")).cast("bigint")
    facts.append(training.report.select(F.lit("lines of the report").alias("name"), lines.alias("value")))
    best = min(training.model.losses) < training.model.losses[0] * 1.0001
    facts.append(spark.range(1).select(F.lit("best epoch kept").alias("name"), F.lit(int(best)).cast("bigint").alias("value")))
    found = facts[0]
    for more in facts[1:]:
        found = found.unionByName(more)
    return found


@query(sql.TRAINED_QUADS)
def trained_model_quads(spark, sf):
    """Metadata of a model that has been trained; what was measured is shown as such."""
    value = F.when(F.col("p") == v.DQV + "value", F.lit("measured")).otherwise(F.col("o.value"))
    return _trained(spark, sf)[1].metadata.select("g", "s", "p", value.alias("o"))


@query()
def train_classifier(spark, sf):
    return _trained(spark, sf)[1].metrics


@query()
def classifier_annotation(spark, sf):
    quads, training = _trained(spark, sf)
    return jobs.classifier_annotation(quads, br.TASK, training.model).annotations


# --- streams ------------------------------------------------------------------


@query(sql.INCREMENTAL)
def incremental_labelling(spark, sf):
    root = scratch_path(spark, "stream")
    docs = br.table(spark, sf, "documents").selectExpr(f"{br.DOC} AS decision", "text")
    # Three batches, each of as many files as tasks can write and read at a time.
    files = max(8, spark.sparkContext.defaultParallelism)
    docs.repartition(3 * files, "decision").write.parquet(f"{root}/in")
    codelist = jobs.stored_codelist(br.quads(spark, sf, "concepts"), br.QUALITY)
    arriving = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")

    def label(batch):
        return jobs.label_decisions(
            batch, codelist, br.QUALITY, task=br.TASK, factory=stubs.chat_factory, prompts=_no_prompts(spark),
            pause_seconds=0, on_failure="quarantine",
        )

    stream = inc.label_stream(
        arriving, label, annotations_path=f"{root}/annotations", containers_path=f"{root}/containers",
        checkpoint=f"{root}/checkpoint", done=inc.of_scheme(codelist),
    )
    stream.awaitTermination()
    return spark.read.schema(inc.ANNOTATION_SCHEMA).parquet(f"{root}/annotations")


@query(sql.STREAM_DEDUP)
def stream_dedup(spark, sf):
    root = scratch_path(spark, "dedup")
    events = br.table(spark, sf, "events").select("ts", "user_id", "event_type")
    events.repartitionByRange(3, "ts").write.parquet(f"{root}/in")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    found = arriving.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("http://ex/user/"), "user_id").alias("target"),
        F.concat(F.lit("http://ex/event/"), "event_type").alias("body"),
    )
    rows = wr.annotation_columns(found, task=br.TASK, agent=v.AGENTS["model_annotator"], keep=["ts"])
    stream = inc.annotation_stream(
        rows, annotations_path=f"{root}/annotations", checkpoint=f"{root}/checkpoint"
    )
    stream.awaitTermination()
    return spark.read.schema(inc.ANNOTATION_SCHEMA).parquet(f"{root}/annotations")
