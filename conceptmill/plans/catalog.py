"""Named queries over the given tables, each with its check in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.functions import rdf_terms as rdf
from conceptmill.operators import graph as q
from conceptmill.operators import labels as lab
from conceptmill.operators import learning as learn
from conceptmill.operators import model_metadata as meta
from conceptmill.operators import prediction as pred
from conceptmill.operators import prompts as prm
from conceptmill.operators import replies as rep
from conceptmill.operators import selection as sel
from conceptmill.operators import text as txt
from conceptmill.operators import writes as wr
from conceptmill.operators.skew import spread_join
from conceptmill.plans import bridge as br
from conceptmill.plans import checks as sql
from conceptmill.plans import stubs

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


# --- selection of decisions ---------------------------------------------------

_LABELLED = ("docs", "anns", "concepts")


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    docs = br.table(spark, sf, "documents").where("doc_id % 6 = 0").selectExpr(f"{br.DOC} AS uri")
    pages = br.table(spark, sf, "pages").selectExpr("concat('http://ex/page/', page_id) AS uri")
    return docs.unionByName(pages)


@query(sql.unannotated(sql.DEFAULT_TARGETS, sql.IN_DECISIONS))
def unannotated_decisions(spark, sf):
    return sel.unannotated_decisions(br.quads(spark, sf, *_LABELLED), br.QUALITY, target_graph=br.DECISIONS)


@query(sql.unannotated(sql.DEFAULT_TARGETS, "true", graphs=f"('{br.AI}')"))
def unannotated_any_graph(spark, sf):
    return sel.unannotated_decisions(br.quads(spark, sf, *_LABELLED), br.QUALITY)


@query(sql.unannotated(sql.NODE_TARGETS, sql.IN_DECISIONS))
def unannotated_by_node(spark, sf):
    return sel.unannotated_decisions(
        br.quads(spark, sf, *_LABELLED), br.QUALITY, target_graph=br.DECISIONS, nodes=_nodes(spark, sf)
    )


@query(sql.unannotated(sql.CLASS_TARGETS, sql.IN_DECISIONS))
def unannotated_by_class(spark, sf):
    return sel.unannotated_decisions(
        br.quads(spark, sf, *_LABELLED), br.QUALITY, target_graph=br.DECISIONS, classes=[v.WORK, v.EXPRESSION]
    )


@query(sql.unannotated(f"{sql.NODE_TARGETS} UNION {sql.WORK_TARGETS}", sql.IN_DECISIONS))
def unannotated_by_node_or_class(spark, sf):
    return sel.unannotated_decisions(
        br.quads(spark, sf, *_LABELLED), br.QUALITY, target_graph=br.DECISIONS,
        nodes=_nodes(spark, sf), classes=[v.WORK],
    )


@query(sql.unannotated(f"{sql.NODE_TARGETS} UNION {sql.WORK_TARGETS}", sql.IN_DECISIONS))
def unannotated_by_shape(spark, sf):
    quads = br.quads(spark, sf, *_LABELLED, "task", "shapes")
    nodes, classes = sel.shape_targets_of_task(quads, br.TASK)
    return sel.unannotated_decisions(
        quads, br.QUALITY, target_graph=br.DECISIONS, nodes=nodes, classes=classes
    )


@query(sql.unannotated(sql.DEFAULT_TARGETS, sql.IN_DECISIONS, inputs=br.IMPACT_TASK))
def unannotated_among_inputs(spark, sf):
    quads = br.quads(spark, sf, *_LABELLED, "inputs")
    return sel.unannotated_decisions(
        quads, br.QUALITY, target_graph=br.DECISIONS, inputs=sel.inputs_of_task(quads, br.IMPACT_TASK)
    )


@query(sql.UNANNOTATED_WITH_TEXT)
def unannotated_with_text(spark, sf):
    return sel.unannotated_with_text(br.quads(spark, sf, *_LABELLED), br.QUALITY, br.DECISIONS)


@query(sql.UNANNOTATED_ONE_TEXT)
def unannotated_with_joined_text(spark, sf):
    return sel.unannotated_with_text(
        br.quads(spark, sf, *_LABELLED), br.QUALITY, br.DECISIONS, one_row_per_decision=True
    )


@query(sql.SKIP_REASONS)
def skip_rules(spark, sf):
    replies = br.table(spark, sf, "documents").selectExpr(
        "doc_id",
        "CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN concat('  ', chr(9), chr(10)) ELSE text END AS text",
        "CASE WHEN doc_id % 4 = 0 THEN array() ELSE array(lang) END AS classes",
    )
    return sel.skip_reasons(replies, classes="classes").select("doc_id", "skip_reason")


@query(sql.annotated("body", "body", br.DECISIONS))
def annotated_with_classes(spark, sf):
    rows = sel.annotated_with_classes(br.quads(spark, sf, *_LABELLED), br.QUALITY)
    return rows.select("decision", F.array_join("classes", "|").alias("classes"), "text")


@query(sql.ANNOTATED_NAMES)
def annotated_with_label_names(spark, sf):
    quads = br.quads(spark, sf, *_LABELLED)
    names = lab.uri_labels(lab.codelist_of_scheme(quads, br.QUALITY))
    rows = sel.annotated_with_classes(quads, br.QUALITY, names=names, one_row_per_decision=True)
    return rows.select("decision", F.array_join("classes", "|").alias("classes"), "text")


@query(sql.CLASSES_TO_LABELS)
def classes_to_labels(spark, sf):
    quads = br.quads(spark, sf, "concepts")
    labelled = br.table(spark, sf, "labels").selectExpr(
        f"{br.DOC} AS decision",
        f"array('{br.TOXIC}', CASE WHEN quality = 1 THEN '{br.HIGH}' ELSE '{br.LOW}' END, 'http://ex/unknown') AS classes",
    )
    named = lab.classes_to_labels(labelled, lab.codelist_of_scheme(quads, br.QUALITY))
    return named.select("decision", F.array_join("names", "|").alias("names"))


@query(sql.ASSESSABLE)
def assessable_expressions(spark, sf):
    quads = br.quads(spark, sf, *_LABELLED, "inputs")
    return sel.assessable_expressions(quads, br.IMPACT_TASK, br.QUALITY, br.DECISIONS)


@query(sql.POLICY_LABELS)
def policy_labels(spark, sf):
    return sel.policy_labels(br.quads(spark, sf, *_LABELLED), br.QUALITY)


# --- job options and inputs ---------------------------------------------------


@query(sql.JOB_CODELISTS)
def job_codelists(spark, sf):
    return sel.task_codelists(br.quads(spark, sf, "jobs"))


@query(sql.JOB_TARGET_GRAPHS)
def job_target_graphs(spark, sf):
    return sel.task_option(br.quads(spark, sf, "jobs"), v.JOB_TARGET_GRAPH, "target_graph")


@query(sql.JOB_SHAPE_TARGETS)
def job_shape_targets(spark, sf):
    return sel.shape_targets(br.quads(spark, sf, "jobs"))


@query(sql.JOB_TEXT_PATHS)
def job_text_paths(spark, sf):
    return sel.task_text_paths(br.quads(spark, sf, "jobs"))


@query(sql.JOB_THRESHOLDS)
def job_thresholds(spark, sf):
    return sel.task_thresholds(br.quads(spark, sf, "jobs"))


@query(sql.TASK_INPUTS)
def task_inputs(spark, sf):
    return sel.task_inputs(br.quads(spark, sf, "inputs"))


@query(sql.INPUT_VIOLATIONS)
def input_violations(spark, sf):
    return sel.input_violations(br.quads(spark, sf, "docs", "inputs"))


# --- codelists and labels -----------------------------------------------------


def _part_codelist(spark, sf) -> DataFrame:
    return lab.codelist_entries(br.quads(spark, sf, "parts"))


def _wanted(spark, sf) -> DataFrame:
    return br.table(spark, sf, "part").selectExpr(f"{br.BRAND} AS scheme", f"{br.WANTED_LABEL} AS label")


@query(sql.CODELIST_ENTRIES)
def codelist_entries(spark, sf):
    return lab.codelist_entries(br.quads(spark, sf, "parts", "nations"))


@query(sql.CODELIST_PROMPT_TEXT)
def codelist_prompt_text(spark, sf):
    return lab.codelist_prompt(_part_codelist(spark, sf)).select("scheme", "code_list")


@query(sql.CODELIST_LABELS)
def codelist_labels(spark, sf):
    listed = lab.codelist_prompt(lab.codelist_entries(br.quads(spark, sf, "parts", "nations")))
    return listed.select("scheme", F.array_join("labels", "|").alias("labels"))


@query(sql.CODELIST_POSITIONS)
def codelist_positions(spark, sf):
    placed = lab.with_positions(_part_codelist(spark, sf))
    return placed.select("scheme", "uri", "label", "ord")


@query(sql.LABEL_VARIANT_MAP)
def label_variant_map(spark, sf):
    return lab.label_variants(_part_codelist(spark, sf))


@query(sql.RESOLVE_EXACT)
def resolve_labels_exact(spark, sf):
    return lab.resolve_labels(_wanted(spark, sf), _part_codelist(spark, sf), prefix=False)


@query(sql.RESOLVE_PREFIX)
def resolve_labels_prefix(spark, sf):
    return lab.resolve_labels(_wanted(spark, sf), _part_codelist(spark, sf))


def _order_replies(spark, sf) -> DataFrame:
    parts = br.table(spark, sf, "part").selectExpr("p_partkey", f"{br.BRAND} AS scheme", f"{br.WANTED_LABEL} AS label")
    lines = br.table(spark, sf, "lineitem").selectExpr(
        "l_partkey AS p_partkey", "concat('http://ex/order/', l_orderkey) AS decision"
    )
    return lines.join(parts, "p_partkey").select("scheme", "decision", F.array("label").alias("classes"))


@query(sql.ANNOTATION_FANOUT)
def annotation_fanout(spark, sf):
    return lab.fan_out(_order_replies(spark, sf), _part_codelist(spark, sf))


@query(sql.NEW_ANNOTATIONS)
def new_annotations(spark, sf):
    docs = br.table(spark, sf, "documents")
    found = docs.selectExpr(
        f"{br.DOC} AS target", f"CASE WHEN doc_id % 3 = 0 THEN '{br.HIGH}' ELSE '{br.LOW}' END AS body"
    )
    new = wr.annotation_rows(
        found.unionByName(found), task=br.TASK, agent=v.AGENTS["model_annotator"]
    )
    existing = wr.annotation_rows(
        br.table(spark, sf, "labels").selectExpr(f"{br.DOC} AS target", f"{br._QUALITY_BODY} AS body"),
        task="http://ex/task/earlier", agent=v.AGENTS["model_annotator"],
    )
    return wr.only_new(new, existing)


def _doc_replies(spark, sf) -> DataFrame:
    return br.table(spark, sf, "documents").selectExpr(
        f"'{br.QUALITY}' AS scheme", f"{br.DOC} AS decision",
        "CASE doc_id % 5 WHEN 0 THEN array() WHEN 1 THEN array('High_quality') "
        "WHEN 2 THEN array('low', 'TOXIC') WHEN 3 THEN array('nonsense') ELSE array('toxic', 'Toxic', 'high') END AS classes",
    )


@query(sql.NO_MATCH_ROWS)
def no_match_rows(spark, sf):
    replies = _doc_replies(spark, sf)
    codelist = lab.codelist_of_scheme(br.quads(spark, sf, "concepts"), br.QUALITY)
    return wr.with_no_match(lab.fan_out(replies, codelist), replies).distinct()


@query(sql.OUTPUT_CONTAINERS)
def output_containers(spark, sf):
    resources = _doc_replies(spark, sf).where(F.size("classes") > 0).select(F.col("decision").alias("resource"))
    quads = wr.container_quads(wr.output_containers(resources, br.TASK))
    return quads.select("g", "s", "p", F.col("o.value").alias("o"), F.col("o.kind").alias("kind"))


@query(sql.ANNOTATION_QUADS)
def annotation_quads(spark, sf):
    found = br.table(spark, sf, "labels").selectExpr(f"{br.DOC} AS target", f"{br._QUALITY_BODY} AS body")
    rows = wr.annotation_rows(found, task=br.TASK, agent=v.AGENTS["classifier_annotator"])
    return wr.annotation_quads(rows).select("g", "s", "p", F.col("o.value").alias("o"))


# --- text ---------------------------------------------------------------------


@query(sql.TEXT_BY_PROPERTY)
def text_by_property(spark, sf):
    decisions = br.table(spark, sf, "documents").selectExpr(f"{br.DOC} AS decision")
    return txt.text_by_path(br.quads(spark, sf, "docs"), decisions, v.DESCRIPTION)


@query(sql.TEXT_BY_PATH)
def text_by_path(spark, sf):
    activities = br.table(spark, sf, "labels").selectExpr("concat('http://ex/activity/', doc_id) AS decision")
    path = [v.GENERATED, [v.HAS_BODY, v.MOTIVATED_BY]]
    return txt.text_by_path(br.quads(spark, sf, "anns"), activities, path)


@query(sql.DECISION_TEXT)
def decision_text(spark, sf):
    docs = br.table(spark, sf, "documents").selectExpr(
        f"{br.DOC} AS decision",
        "CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS title",
        "CASE WHEN doc_id % 4 = 0 THEN lang END AS description",
        "CASE WHEN doc_id % 5 = 0 THEN ' ' END AS decision_basis",
        "text AS content",
    )
    return docs.select("decision", txt.join_nonempty(*v.TEXT_PROPERTIES).alias("text"))


@query(sql.TEXT_PATH_OR_DEFAULT)
def text_path_or_default(spark, sf):
    quads = br.quads(spark, sf, "docs")
    decisions = br.table(spark, sf, "documents").selectExpr(f"{br.DOC} AS decision")
    default = sel.text_per_decision(quads)
    chosen = txt.text_of_decisions(quads, decisions, v.TITLE, default).withColumn("source", F.lit("path"))
    return chosen.unionByName(
        txt.text_of_decisions(quads, decisions, None, default).withColumn("source", F.lit("default"))
    )


# --- learning data ------------------------------------------------------------


def _quality_codelist(spark, sf) -> DataFrame:
    return lab.codelist_of_scheme(br.quads(spark, sf, "concepts"), br.QUALITY)


def _quality_labelled(spark, sf) -> DataFrame:
    return br.table(spark, sf, "labels").selectExpr(
        f"{br.DOC} AS decision",
        "concat(CASE WHEN doc_id % 19 = 0 THEN array('http://ex/concept/void') ELSE array() END, "
        "array(CASE WHEN quality = 1 THEN 'High quality' ELSE 'Low quality' END), "
        "CASE WHEN toxic = 1 THEN array('toxic') ELSE array() END) AS classes",
    )


def _vectors(spark, sf) -> DataFrame:
    return br.table(spark, sf, "embeddings").selectExpr(
        "vec_id", "CAST(label AS BIGINT) AS id",
        # All values, folded: logit i is the sum of values i, i + 10, ...
        "transform(sequence(0, 9), i -> aggregate(filter(embedding, (x, j) -> j % 10 = i), 0D, "
        "(total, x) -> total + CAST(x AS DOUBLE)) * 20) AS logits",
    )


@query(sql.LABEL_IDS)
def label_ids(spark, sf):
    return learn.label_ids(_part_codelist(spark, sf))


@query(sql.MULTI_HOT)
def multi_hot(spark, sf):
    ids = learn.label_ids(_quality_codelist(spark, sf)).select("label", "id")
    rows = learn.multi_hot(_quality_labelled(spark, sf), ids)
    return rows.select("decision", F.array_join(F.transform("target", lambda x: x.cast("int").cast("string")), "").alias("target"))


@query(sql.SINGLE_LABEL_IDS)
def single_label_ids(spark, sf):
    ids = learn.label_ids(_quality_codelist(spark, sf)).select("label", "id")
    return learn.single_label_ids(_quality_labelled(spark, sf), ids)


@query(sql.UNKNOWN_CLASSES)
def unknown_classes(spark, sf):
    ids = learn.label_ids(_quality_codelist(spark, sf)).select("label", "id")
    return learn.unknown_classes(_quality_labelled(spark, sf), ids)


@query(sql.PROBLEM_TYPE)
def problem_type(spark, sf):
    labelled = _quality_labelled(spark, sf)
    single = labelled.select("decision", F.slice("classes", 1, 1).alias("classes"))
    return (
        learn.problem_type(labelled).withColumn("rows", F.lit("all"))
        .unionByName(learn.problem_type(single).withColumn("rows", F.lit("first")))
    )


@query(sql.SPLIT_STRATIFIED)
def split_stratified(spark, sf):
    rows = _vectors(spark, sf).selectExpr("concat('http://ex/vec/', vec_id) AS decision", "id")
    return learn.split_stratified(rows)


@query(sql.SPLIT_GLOBAL)
def split_global(spark, sf):
    return learn.split_global(br.table(spark, sf, "documents").selectExpr(f"{br.DOC} AS decision"))


# --- predictions and metrics --------------------------------------------------


@query(sql.PREDICT_SINGLE)
def predict_single(spark, sf):
    found = pred.predict(_vectors(spark, sf), v.SINGLE_LABEL, threshold=0.4)
    one = F.get("predictions", F.lit(0))
    return found.select(
        "vec_id", one["label"].cast("bigint").alias("label"), F.round(one["confidence"], 6).alias("confidence")
    )


@query(sql.PREDICT_MULTI)
def predict_multi(spark, sf):
    found = pred.predict(_vectors(spark, sf), v.MULTI_LABEL, threshold=0.9)
    return found.select("vec_id", F.explode("predictions").alias("x")).select(
        "vec_id", F.col("x.label").cast("bigint").alias("label"), F.round("x.confidence", 6).alias("confidence")
    )


def _judged_single(spark, sf) -> DataFrame:
    return _vectors(spark, sf).select(
        F.expr("concat('demo/model-', vec_id % 4)").alias("model_id"),
        F.col("id").cast("int").alias("truth"),
        pred.evaluation_labels(F.col("logits"), v.SINGLE_LABEL).alias("predicted"),
    )


def _judged_multi(spark, sf) -> DataFrame:
    truth = F.expr("transform(sequence(0, 9), i -> CAST(i = id OR i = vec_id % 7 AS INT))")
    return _vectors(spark, sf).select(
        truth.alias("truth"), pred.evaluation_labels(F.col("logits"), v.MULTI_LABEL).alias("predicted")
    )


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.round(n, 6).alias(n) if n in sql.METRICS else F.col(n) for n in rows.columns])


@query(sql.METRICS_SINGLE)
def metrics_single(spark, sf):
    return _rounded(pred.metrics(_judged_single(spark, sf).drop("model_id"), v.SINGLE_LABEL))


@query(sql.METRICS_MULTI)
def metrics_multi(spark, sf):
    return _rounded(pred.metrics(_judged_multi(spark, sf), v.MULTI_LABEL))


def _models(spark, sf) -> DataFrame:
    scores = _rounded(pred.metrics(_judged_single(spark, sf), v.SINGLE_LABEL, by=["model_id"]))
    results = F.array(
        *[F.struct(F.lit(f"eval_{n}").alias("name"), F.col(n).alias("value")) for n in sql.METRICS]
    )
    named = br.table(spark, sf, "embeddings").selectExpr(
        "concat('demo/model-', vec_id % 4) AS model_id", "concat('label ', label) AS name"
    )
    labels = named.groupBy("model_id").agg(F.collect_set("name").alias("labels"))
    return scores.join(labels, "model_id").select(
        "model_id", "labels", results.alias("results"),
        F.md5("model_id").alias("commit_oid"), F.md5(F.reverse("model_id")).alias("code_git_sha"),
        F.concat(F.lit("https://hub.example.org/"), "model_id").alias("repo_url"),
        F.concat(F.lit("https://hub.example.org/"), "model_id", F.lit("/tree/main/")).alias("tree_url"),
        F.lit("https://git.example.org/code").alias("source_repo_url"),
        F.expr(
            "CASE WHEN model_id < 'demo/model-2' THEN timestamp_ntz'2024-01-15 10:00:00' "
            "ELSE timestamp_ntz'2024-07-15 10:00:00.25' END"
        ).alias("published"),
        F.lit("base/encoder").alias("transformer"), F.expr("date'2024-03-01'").alias("trained"),
    )


@query(sql.MODEL_METADATA)
def model_metadata_quads(spark, sf):
    return meta.metadata_quads(_models(spark, sf)).select(
        "g", "s", "p", F.col("o.value").alias("o"), F.col("o.kind").alias("kind"),
        F.coalesce("o.datatype", F.lit("")).alias("datatype"),
    )


@query(sql.MODEL_REPORT)
def model_report(spark, sf):
    return meta.model_report(_models(spark, sf))


# --- prompts and replies ------------------------------------------------------


def _prompts(spark, sf) -> DataFrame:
    """Prompts per brand, with placeholders in turn, and a default one."""
    rows = br.table(spark, sf, "part").where("p_partkey % 10 = 3").selectExpr(
        f"{br.BRAND} AS scheme",
        "concat('system for ', p_brand) AS system_message",
        "'{{x}} {decision_text} | {code_list} | {decision_text}' AS user_message",
    )
    default = br.table(spark, sf, "region").where("r_regionkey = 0").selectExpr(
        "'default' AS scheme", "concat('for ', r_name) AS system_message", "'{code_list}: {decision_text}' AS user_message"
    )
    return rows.distinct().unionByName(default)


@query(sql.PROMPT_CHOICE)
def prompt_choice(spark, sf):
    schemes = br.quads(spark, sf, "parts", "nations").where(F.col("p") == v.IN_SCHEME).select(
        F.col("o.value").alias("scheme")
    )
    return prm.prompts_for_schemes(schemes, _prompts(spark, sf))


@query(sql.PROMPT_RENDERED)
def prompt_rendered(spark, sf):
    docs = br.table(spark, sf, "documents").selectExpr(
        f"{br.DOC} AS decision",
        "CASE WHEN doc_id % 2 = 0 THEN concat('{code_list} ', text) ELSE text END AS text",
        "CASE WHEN doc_id % 3 = 0 THEN '{{{decision_text}}} from {code_list}{code_list}' "
        "ELSE 'Codes {code_list} for {decision_text}.' END AS template",
    )
    code_list = lab.codelist_prompt(_quality_codelist(spark, sf)).select("code_list").scalar()
    return docs.withColumn("code_list", code_list).select(
        "decision", prm.label_prompt(F.col("template"), F.col("code_list"), F.col("text")).alias("prompt")
    )


@query(sql.IMPACT_PROMPT)
def impact_prompt(spark, sf):
    return br.table(spark, sf, "documents").select(
        "doc_id", F.lit(v.IMPACT_SYSTEM_MESSAGE).alias("system_message"),
        prm.impact_prompt(F.col("text"), F.col("source")).alias("user_message"),
    )


@query(sql.RANDOM_LABEL)
def random_label(spark, sf):
    parts = br.table(spark, sf, "part").selectExpr(f"{br.PART} AS decision", f"{br.BRAND} AS scheme")
    return prm.random_labels(parts, _part_codelist(spark, sf)).select("decision", "label")


@query(sql.PARSE_REPLIES)
def parse_replies(spark, sf):
    rows = br.table(spark, sf, "documents").selectExpr("doc_id", f"{stubs.REPLY_SQL} AS raw")
    parsed = rep.parse_replies(rows)
    return parsed.select("doc_id", F.array_join("classes", "|").alias("classes"), "parse_error")


@query(sql.PARSE_BARE_LISTS)
def parse_replies_bare_list(spark, sf):
    rows = br.table(spark, sf, "documents").selectExpr("doc_id", f"{stubs.REPLY_SQL} AS raw")
    parsed = rep.parse_replies(rows, accept_bare_list=True)
    return parsed.select("doc_id", F.array_join("classes", "|").alias("classes"))


@query(sql.PARSE_IMPACT)
def parse_impact(spark, sf):
    rows = br.table(spark, sf, "documents").selectExpr("doc_id", f"{stubs.IMPACT_SQL} AS raw")
    a = F.col("assessment")
    return rep.parse_impact(rows).select(
        "doc_id", a["label"].alias("label"), a["impact_direction"].alias("impact_direction"),
        a["confidence"].alias("confidence"), a["reasoning"].alias("reasoning"),
        F.array_join(a["direct_effects"], "|").alias("direct_effects"),
        F.array_join(a["second_order_effects"], "|").alias("second_order_effects"),
        F.array_join(a["key_uncertainties"], "|").alias("key_uncertainties"),
        a["summary"].alias("summary"), "impact_uri",
    )


@query(sql.IMPACT_DIRECTION_URI)
def impact_direction_uri(spark, sf):
    rows = br.table(spark, sf, "documents").selectExpr("doc_id", f"{stubs.DIRECTION_SQL} AS direction")
    return rows.select("doc_id", wr.direction_uri(F.col("direction")).alias("uri"))


@query(sql.STORE_IMPACT)
def store_impact(spark, sf):
    verdicts = br.table(spark, sf, "documents").selectExpr(
        "concat('http://ex/ann/', doc_id, '/quality') AS annotation", f"{stubs.DIRECTION_SQL} AS impact_direction"
    )
    quads = wr.impact_quads(verdicts, br.quads(spark, sf, "anns"))
    return quads.select("g", "s", "p", F.col("o.value").alias("o"))


# --- RDF terms ----------------------------------------------------------------


@query(sql.RDF_TERMS)
def rdf_terms(spark, sf):
    orders = br.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate",
        F.expr("concat(o_orderpriority, chr(39), chr(34), chr(92))").alias("note"),
        F.expr("concat('http://ex/', o_orderpriority, '<', chr(34), '>')").alias("uri"),
        F.expr("o_totalprice > 100000").alias("big"),
    )
    return orders.select(
        "o_orderkey",
        rdf.term(orders, "note").alias("text_term"), rdf.uri_term(F.col("uri")).alias("uri_term"),
        rdf.term(orders, "o_orderkey").alias("int_term"), rdf.term(orders, "o_totalprice").alias("float_term"),
        rdf.term(orders, "big").alias("bool_term"), rdf.term(orders, "o_orderdate").alias("datetime_term"),
        rdf.date_term(F.col("o_orderdate")).alias("date_term"),
    )


@query(sql.RDF_TIMES)
def rdf_times(spark, sf):
    events = br.table(spark, sf, "events")
    return events.select(
        "event_id", rdf.time_term(F.col("ts")).alias("time_term"), rdf.datetime_term(F.col("ts")).alias("datetime_term"),
        rdf.float_term(F.col("value") * 1e9).alias("large_term"), rdf.float_term(F.col("value") / 1048576).alias("small_term"),
    )


@query(sql.TERM_ACCESSORS)
def term_accessors(spark, sf):
    quads = br.quads(spark, sf, "docs").where(F.col("p").isin(v.CONTENT, v.DESCRIPTION))
    return quads.select("g", "s", "p", rdf.lexical(F.col("o")).alias("text"), rdf.language(F.col("o")).alias("lang"))


# --- graph algebra ------------------------------------------------------------


@query(sql.STAR_JOIN)
def star_join(spark, sf):
    quads = br.quads(spark, sf, "anns")
    targets = q.pattern(quads, v.HAS_TARGET, "ann", "target", graphs=br.AI)
    bodies = q.pattern(quads, v.HAS_BODY, "ann", "body", graphs=br.AI)
    return q.exists(bodies.join(targets, "ann"), sel.classifying_annotations(quads, [br.AI]), ["ann"])


@query(sql.CHAIN_JOIN)
def chain_join(spark, sf):
    quads = br.quads(spark, sf, "docs", "inputs")
    containers = q.pattern(quads, v.INPUT_CONTAINER, "task", "container", graphs=br.JOBS)
    resources = q.pattern(quads, v.HAS_RESOURCE, "container", "expression", graphs=br.CONTAINERS)
    works = q.pattern(quads, v.REALIZED_BY, "work", "expression", graphs=br.DECISIONS)
    listed = spread_join(resources, containers, ["container"], "inner", spread=["expression"])
    return listed.join(works, "expression")


@query(sql.CROSS_GRAPH_JOIN)
def cross_graph_join(spark, sf):
    quads = br.quads(spark, sf, *_LABELLED)
    bodies = q.pattern(quads, v.HAS_BODY, "ann", "concept", graphs=br.AI)
    labels = q.pattern(quads, v.PREF_LABEL, "concept", "label", graphs=br.PUBLIC)
    return spread_join(bodies, labels, ["concept"], "inner", spread=["ann"])


@query(sql.ANY_GRAPH_JOIN)
def any_graph_join(spark, sf):
    quads = br.quads(spark, sf, "docs")
    typed = q.instances(quads, v.EXPRESSION, "s", g="g")
    contents = q.pattern(quads, v.CONTENT, "s", "content", g="g")
    return typed.join(contents, ["g", "s"])


@query(sql.DEFAULT_GRAPH)
def default_graph(spark, sf):
    return q.pattern(br.quads(spark, sf, "docs", "parts"), [v.CONTENT, v.IN_SCHEME], "s", "o")


@query(sql.OPTIONAL_FILTER)
def optional_filter(spark, sf):
    quads = br.quads(spark, sf, "parts")
    labels = q.pattern(quads, v.PREF_LABEL, "s", "label")
    definitions = quads.where((F.col("p") == v.DEFINITION) & (rdf.language(F.col("o")) == "en"))
    return q.optional(labels, definitions.select("s", F.col("o.value").alias("definition")), ["s"])


@query(sql.PATH_ALTERNATION)
def path_alternation(spark, sf):
    return q.pattern(br.quads(spark, sf, "concepts", "parts"), [v.IN_SCHEME, v.FOR_SCHEME], "concept", "scheme", g="g")


@query(sql.ANNOTATION_COUNTS)
def annotation_counts(spark, sf):
    return q.count(q.pattern(br.quads(spark, sf, "anns"), v.HAS_TARGET, "ann", "target", g="g"), "ann", ["target"])


@query(sql.PREDICATE_COUNTS)
def predicate_counts(spark, sf):
    quads = br.quads(spark, sf, "docs", "anns", "concepts", "parts", "nations", "jobs", "inputs", "task")
    return quads.groupBy("g", "p").agg(F.count("o").alias("n"), F.count_distinct("s").alias("subjects"))
