"""The jobs: selection, labelling or assessment, and the rows to write."""

from __future__ import annotations

import datetime
import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.functions.text import is_blank
from conceptmill.operators import classifier as clf
from conceptmill.operators import labels as lab
from conceptmill.operators import learning as learn
from conceptmill.operators import model_calls as calls
from conceptmill.operators import model_metadata as meta
from conceptmill.operators import prediction as pred
from conceptmill.operators import prompts as prm
from conceptmill.operators import replies as rep
from conceptmill.operators import selection as sel
from conceptmill.operators import text as txt
from conceptmill.operators import writes as wr
from conceptmill.session import scratch_path
from conceptmill.sources.journal import FAILED, ReplyJournal
from conceptmill.sources.tables import materialised


@dataclass
class JobResult:
    """What a job wants written, and what it did not do.

    ``failed`` are rows that got no usable reply, ``skipped`` (decision, skip_reason) decisions that were
    not sent, ``unresolved`` (decision, label) labels that are in no codelist.
    """

    annotations: DataFrame
    containers: DataFrame
    failed: DataFrame | None = None
    skipped: DataFrame | None = None
    unresolved: DataFrame | None = None

    def quads(self) -> DataFrame:
        return wr.annotation_quads(self.annotations).unionByName(wr.container_quads(self.containers))


def stored_codelist(quads: DataFrame, scheme: str) -> DataFrame:
    """The codelist of a job as a small table of its own; an empty one is an error.

    A job uses it for the prompt and for every label lookup, so it is read from
    the quads once, and the planner knows its size.
    """
    codelist = materialised(lab.codelist_entries(quads, scheme), "codelist")
    if codelist.isEmpty():
        raise RuntimeError(f"no concepts found for concept scheme {scheme}")
    return codelist


# Requests of a chunk for each caller, and chunks of a round beyond which they grow.
CHUNK_ROWS, MOST_CHUNKS = 1000, 24


def ask_model(
    requests: DataFrame,
    factory: calls.ChatFactory | Sequence[calls.ChatFactory],
    parse: Callable[[DataFrame], DataFrame],
    *,
    keep: Sequence[str] = (),
    attempts: int = 3,
    pause_seconds: float = 1.0,
    on_failure: str = "raise",
    delay_seconds: float = 0.0,
    max_callers: int | None = None,
    calls_per_second: float | None = None,
    store: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Send (id, keep.., system_message, user_message) to a model until the replies parse.

    ``parse`` adds ``parse_error`` to (id, keep.., raw, call_error). A failed
    call or parse puts only that row into the next attempt, after a pause that
    grows with the attempt. Several factories are the models of the first, second, ..
    attempt, the last one of all later ones. Returns the parsed rows and the rows that failed every attempt; the
    latter are an error with ``on_failure='raise'`` and a result with
    ``'quarantine'``.

    ``max_callers`` bounds the calls at the same time; requests are then sent in chunks of
    CHUNK_ROWS a caller, or of one part in MOST_CHUNKS of a round that would have more chunks, so a lost
    task repeats few calls and a round has no more jobs than that. ``calls_per_second`` is the
    rate of the whole job: every request, also a repeated one, has its send time (see
    ``calls.Schedule``); its callers are one unless ``max_callers`` says more. Without
    either, every task calls.

    All replies go to a journal, chunk by chunk, before anything else uses them: ``store``, or else a new
    folder under the shared one, named in the error when a job gives up. A job given the
    journal of another as ``store`` asks only for what has no usable reply to the same message there.
    """
    if on_failure not in ("raise", "quarantine"):
        raise ValueError(f"unknown on_failure: {on_failure}")
    spark = requests.sparkSession
    models = list(factory) if isinstance(factory, Sequence) else [factory]
    asked = F.sha2(F.concat_ws("\u001f", "system_message", "user_message"), 256)
    requests = materialised(requests.withColumn("asked", asked), "requests")
    path = store or scratch_path(spark, "replies")
    journal = ReplyJournal(spark, path, dict(requests.dtypes)["id"])
    about = requests.select("id", *keep, "asked")
    no_error = F.lit(None).cast("string").alias("call_error")

    def parsed(raw: DataFrame) -> DataFrame:
        return parse(about.join(raw, ["id", "asked"]).select("id", *keep, "asked", "raw", no_error))

    pending, known = requests, None
    if store:
        known = materialised(parsed(journal.usable()).where("parse_error IS NULL"), "replies-known")
        pending = requests.join(known.select("id"), "id", "left_anti")
    callers = max_callers or (1 if calls_per_second else None)
    begun, sent, bad = time.time(), 0, None
    for attempt in range(1, attempts + 1):
        if callers:
            n_pending = pending.count()
            slots = calls.send_slots(pending, callers, calls_per_second or math.inf, first=sent)
            size = callers * max(CHUNK_ROWS, math.ceil(n_pending / (callers * MOST_CHUNKS)))
            journal.requests(slots.withColumn("chunk", F.floor((F.col("number") - sent) / size).cast("int")), attempt)
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slots.schema)
            schedule = calls.Schedule(begun, calls_per_second, callers) if calls_per_second else None
            chunks = [journal.chunk(schema, attempt, k) for k in range(math.ceil(n_pending / size))]
            sent += n_pending
        else:
            chunks, schedule = [pending], None
        for k, chunk in enumerate(chunks):
            raw = calls.call_model(
                chunk, models[min(attempt, len(models)) - 1], keep=[*keep, "asked"], delay_seconds=delay_seconds,
                max_callers=callers, schedule=schedule, timed=True,
            )
            journal.commit(parse(raw), attempt, k)
        bad = journal.own(attempt).where(FAILED)
        if attempt == attempts or bad.isEmpty():
            break
        # Written, so that the next attempt reads the prompts it sends and not all of them.
        pending = materialised(pending.join(bad.select("id"), "id", "left_semi"), "requests-again")
        time.sleep(attempt * pause_seconds)
    answered = parsed(journal.own().where(f"NOT ({FAILED})").select("id", "asked", "raw"))
    if known is not None:
        answered = answered.unionByName(known)
    bad = about.join(bad.select("id", "asked", "raw", "call_error", "parse_error"), ["id", "asked"])
    if on_failure == "raise":
        first = bad.first()
        if first is not None:
            reason = first["call_error"] or first["parse_error"]
            raise RuntimeError(
                f"model call failed after {attempts} attempts for {first['id']}: {reason}; usable replies are in {path}"
            )
    # Written, as the caller uses the answers several times and each use would parse all replies again.
    return materialised(answered, "answered"), bad.select("id", *keep, "asked", "raw", "call_error", "parse_error")


def label_requests(decisions: DataFrame, codelist: DataFrame, prompts: DataFrame) -> DataFrame:
    """(id, system_message, user_message) for (decision, text) and a codelist of one scheme.

    Prompt and code list are one row, attached as a scalar: all decisions share
    the scheme, so a join on it would send them all to one task.
    """
    context = lab.codelist_prompt(codelist).join(prm.prompts_for_schemes(codelist, prompts), "scheme")
    row = context.select(F.struct("system_message", "user_message", "code_list").alias("row")).scalar()
    return decisions.withColumn("context", row).select(
        F.col("decision").alias("id"),
        F.col("context.system_message").alias("system_message"),
        prm.label_prompt(F.col("context.user_message"), F.col("context.code_list"), F.col("text")).alias("user_message"),
    )


def label_decisions(
    decisions: DataFrame,
    codelist: DataFrame,
    scheme: str,
    *,
    task: str,
    factory: calls.ChatFactory | Sequence[calls.ChatFactory] | None,
    prompts: DataFrame,
    accept_bare_list: bool = False,
    existing: DataFrame | None = None,
    **model_options,
) -> JobResult:
    """Label (decision, text) with a model; blank texts are skipped.

    ``existing`` are annotations (target, body, motivated_by, agent_uri) that are not made again.

    Without a ``factory`` each decision gets a label fixed by its URI, which
    serves tests. All decisions go through the same plan at once.
    """
    judged = sel.skip_reasons(decisions)
    skipped = judged.where("skip_reason IS NOT NULL").select("decision", "skip_reason")
    texts, failed = judged.where("skip_reason IS NULL").drop("skip_reason"), None
    if factory is None:
        picked = prm.random_labels(texts.select(F.lit(scheme).alias("scheme"), "decision"), codelist)
        answered = materialised(picked.select(F.col("decision").alias("id"), F.array("label").alias("classes")), "picked")
    else:
        answered, failed = ask_model(
            label_requests(texts, codelist, prompts),
            factory,
            lambda rows: rep.parse_replies(rows, accept_bare_list=accept_bare_list),
            **model_options,
        )
    replies = answered.select(F.lit(scheme).alias("scheme"), F.col("id").alias("decision"), "classes")
    fanned = materialised(lab.fan_out(replies, codelist), "resolved")
    unresolved = fanned.where("uri IS NULL").select("decision", "label")
    annotations = wr.annotation_rows(wr.with_no_match(fanned, replies), task=task, agent=v.AGENTS["model_annotator"])
    if existing is not None:
        annotations = wr.only_new(annotations, existing)
    containers = wr.output_containers(replies.select(F.col("decision").alias("resource")), task)
    return JobResult(annotations, containers, failed, skipped, unresolved)


def batch_model_annotation(
    quads: DataFrame, task: str, *, factory: calls.ChatFactory | None, prompts: DataFrame, **options
) -> JobResult:
    """Label every decision of the task that has no annotation for its codelist yet."""
    settings = sel.job_settings(quads, task)
    scheme = settings.codelist
    codelist = stored_codelist(quads, scheme)
    nodes, classes = sel.shape_targets_of_task(quads, task)
    decisions = sel.unannotated_decisions(
        quads,
        scheme,
        target_graph=settings.target_graph,
        nodes=nodes,
        classes=classes,
        inputs=sel.valid_inputs_of_task(quads, task),
    )
    default = sel.text_per_decision(quads, decisions)
    texts = txt.text_of_decisions(quads, decisions, settings.text_path, default)
    return label_decisions(
        texts, codelist, scheme, task=task, factory=factory, prompts=prompts,
        existing=wr.stored_annotations(quads, v.AGENTS["model_annotator"]), **options,
    )


def model_annotation(
    quads: DataFrame,
    task: str,
    source: str,
    *,
    factory: calls.ChatFactory | None,
    prompts: DataFrame,
    path: str | None = None,
    **options,
) -> JobResult:
    """Label one decision, annotated or not."""
    scheme = sel.job_settings(quads, task).codelist
    codelist = stored_codelist(quads, scheme)
    own = quads.where(F.col("s") == source)
    decisions = quads.sparkSession.createDataFrame([(source,)], "decision string")
    # A path may lead to other subjects, so it needs all quads.
    texts = txt.text_of_decisions(quads if path else own, decisions, path, sel.text_per_decision(own))
    return label_decisions(
        texts, codelist, scheme, task=task, factory=factory, prompts=prompts,
        existing=wr.stored_annotations(quads, v.AGENTS["model_annotator"]), **options,
    )


def annotate_predictions(
    predicted: DataFrame, codelist: DataFrame, scheme: str, *, task: str, existing: DataFrame
) -> JobResult:
    """Annotations for (decision, predictions); decisions without a prediction give nothing.

    Predictions are written first: labels and decisions use them, but texts are
    scored once.
    """
    replies = materialised(
        predicted.where(F.size("predictions") > 0).select(
            F.lit(scheme).alias("scheme"), "decision", F.col("predictions.label").alias("classes")
        ),
        "predictions",
    )
    fanned = materialised(lab.fan_out(replies, codelist), "resolved")
    found = fanned.where(F.col("uri").isNotNull()).select(
        F.col("decision").alias("target"), F.col("uri").alias("body")
    )
    annotations = wr.annotation_rows(found, task=task, agent=v.AGENTS["classifier_annotator"])
    annotations = wr.only_new(annotations, existing)
    containers = wr.output_containers(replies.select(F.col("decision").alias("resource")), task)
    return JobResult(annotations, containers, unresolved=fanned.where("uri IS NULL").select("decision", "label"))


def _open_texts(quads: DataFrame, task: str) -> tuple[sel.JobSettings, DataFrame]:
    settings = sel.job_settings(quads, task)
    graph = settings.require_target_graph()
    inputs = sel.valid_inputs_of_task(quads, task)
    return settings, sel.unannotated_with_text(quads, settings.codelist, graph, inputs=inputs)


def classifier_annotation(
    quads: DataFrame, task: str, model: clf.TextClassifier, *, default_threshold: float = v.DEFAULT_THRESHOLD
) -> JobResult:
    """Label un-annotated decisions of the target graph with a fitted classifier."""
    learn.check_problem_type(model.problem)
    settings, texts = _open_texts(quads, task)
    scheme = settings.codelist
    codelist = stored_codelist(quads, scheme)
    threshold = default_threshold if settings.threshold is None else settings.threshold
    scored = model.transform(texts.where(~is_blank(F.col("text"))))
    names = F.array(*[F.lit(name) for name in model.labels])
    predicted = pred.predict(scored, model.problem, threshold=threshold, labels=names)
    existing = wr.stored_annotations(quads, v.AGENTS["classifier_annotator"])
    return annotate_predictions(predicted, codelist, scheme, task=task, existing=existing)


def classifier_annotation_with(
    quads: DataFrame,
    task: str,
    factory: calls.ScorerFactory,
    labels: Sequence[str],
    problem: str,
    *,
    default_threshold: float = v.DEFAULT_THRESHOLD,
) -> JobResult:
    """The same with a user-supplied scorer; texts it fails on are in ``failed``."""
    learn.check_problem_type(problem)
    settings, texts = _open_texts(quads, task)
    scheme = settings.codelist
    codelist = stored_codelist(quads, scheme)
    threshold = default_threshold if settings.threshold is None else settings.threshold
    rows = texts.where(~is_blank(F.col("text"))).withColumnRenamed("decision", "id")
    scored = materialised(calls.score_texts(rows, factory), "scores").withColumnRenamed("id", "decision")
    names = F.array(*[F.lit(name) for name in labels])
    usable = scored.where(F.col("error").isNull())
    predicted = pred.predict(usable, problem, threshold=threshold, labels=names)
    existing = wr.stored_annotations(quads, v.AGENTS["classifier_annotator"])
    result = annotate_predictions(predicted, codelist, scheme, task=task, existing=existing)
    result.failed = scored.where(F.col("error").isNotNull()).select("decision", "error")
    return result


@dataclass(frozen=True)
class ModelAbout:
    """What the metadata of a model says besides its measures."""

    model_id: str
    commit_oid: str
    code_git_sha: str
    repo_url: str
    tree_url: str
    source_repo_url: str
    published: datetime.datetime
    transformer: str = "hashed term weights"


@dataclass
class Training:
    """A fitted classifier with its test metrics, its examples and the rejected class values.

    ``metadata`` (quads) and ``report`` describe the model when the job was told about it.
    """

    model: clf.TextClassifier
    metrics: DataFrame
    judged: DataFrame
    rejected: DataFrame
    examples: DataFrame
    metadata: DataFrame | None = None
    report: DataFrame | None = None


def described_model(metrics: DataFrame, model: clf.TextClassifier, about: ModelAbout) -> DataFrame:
    """The one row that ``metadata_quads`` and ``model_report`` take, from the measures of a training."""
    measures = [F.struct(F.lit(f"eval_{name}").alias("name"), F.col(name).alias("value")) for name in metrics.columns]
    if model.losses:
        measures.insert(0, F.struct(F.lit("eval_loss").alias("name"), F.lit(min(model.losses)).alias("value")))
    return metrics.select(
        *(F.lit(value).alias(name) for name, value in vars(about).items()),
        F.array(*measures).alias("results"),
        F.array(*map(F.lit, model.labels)).alias("labels"),
        F.to_date(F.lit(about.published)).alias("trained"),
    )


def train_classifier(
    quads: DataFrame, task: str, *, about: ModelAbout | None = None, **fit_options
) -> Training | None:
    """Fit and evaluate a classifier on the annotated decisions; None without any.

    The test set also decides which epoch is kept. With ``about`` the training ends in the quads and the
    report that describe the model.
    """
    scheme = sel.job_settings(quads, task).codelist
    codelist = stored_codelist(quads, scheme)
    ids = learn.label_ids(codelist).select("label", "id")
    labelled = materialised(
        sel.annotated_with_classes(
            quads,
            scheme,
            inputs=sel.valid_inputs_of_task(quads, task),
            names=lab.uri_labels(codelist),
            one_row_per_decision=True,
        ).where(F.size("classes") > 0),
        "labelled",
    )
    if labelled.isEmpty():
        return None
    problem = learn.problem_type(labelled).first()["problem_type"]
    # The label space has one row per codelist entry and is the width of every logit array.
    places = {row["id"]: row["label"] for row in ids.collect()}
    labels = [places.get(i, "") for i in range(max(places) + 1)]
    if problem == v.SINGLE_LABEL:
        encoded = learn.single_label_ids(labelled, ids)
        split = learn.split_stratified(encoded).select("decision", F.col("id").alias("target"), "split")
    else:
        encoded = learn.multi_hot(labelled, ids, size=len(labels))
        split = encoded.join(learn.split_global(encoded), "decision")
    examples = materialised(labelled.select("decision", "text").join(split, "decision"), "examples")
    test = examples.where("split = 'test'")
    model = clf.fit_classifier(examples.where("split = 'train'"), labels, problem, validation=test, **fit_options)
    tested = materialised(model.transform(test), "tested")
    judged = tested.select(
        "decision",
        F.col("target").alias("truth"),
        pred.evaluation_labels(F.col("logits"), problem).alias("predicted"),
    )
    measured = materialised(pred.metrics(judged, problem), "metrics")
    training = Training(model, measured, judged, learn.unknown_classes(labelled, ids), examples)
    if about:
        models = described_model(measured, model, about)
        training.metadata, training.report = meta.metadata_quads(models), meta.model_report(models)
    return training


@dataclass
class ImpactResult:
    quads: DataFrame
    containers: DataFrame
    failed: DataFrame


def impact_requests(quads: DataFrame, task: str) -> DataFrame:
    """(expression, annotation, concept, label, lang, work, id, messages) to assess."""
    settings = sel.job_settings(quads, task)
    scheme = settings.codelist
    expressions = sel.assessable_expressions(quads, task, scheme, settings.require_target_graph())
    pairs = expressions.join(sel.policy_labels(quads, scheme), "expression")
    return pairs.select(
        F.sha2(F.concat_ws("\u001f", "expression", "lang", "work", "annotation", "concept", "label"), 256).alias("id"),
        "expression", "annotation", "concept", "label",
        F.lit(v.IMPACT_SYSTEM_MESSAGE).alias("system_message"),
        F.concat(prm.impact_prompt(F.col("content"), F.col("label")), F.lit(prm.impact_format())).alias("user_message"),
    )


def impact_assessment(quads: DataFrame, task: str, *, factory: calls.ChatFactory, **model_options) -> ImpactResult:
    """Assess the annotations of the task's expressions and store the verdicts."""
    about = ["annotation", "concept", "label"]

    def parse(rows: DataFrame) -> DataFrame:
        parsed = rep.parse_impact(rows)
        return parsed.withColumn("parse_error", F.when(F.col("assessment").isNull(), F.lit("invalid assessment")))

    # A single attempt, as a failed assessment is an error of the job.
    options = {"attempts": 1, **model_options}
    answered, failed = ask_model(impact_requests(quads, task), factory, parse, keep=about, **options)
    verdicts = answered.select(*about, F.col("assessment.impact_direction").alias("impact_direction"))
    stored = wr.impact_quads(verdicts, quads)
    containers = wr.output_containers(verdicts.select(F.col("annotation").alias("resource")), task)
    return ImpactResult(stored, containers, failed)
