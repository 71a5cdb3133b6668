"""Rows to write: annotations, containers, impact bodies, and set-wise appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.functions.text import name_uuid
from conceptmill.operators import graph as q

ANNOTATION_KEY = ("target", "body", "motivated_by", "agent_uri")


def annotation_columns(
    found: DataFrame, *, task: str, agent: str, graph: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Annotation columns for each (target, body); ids are derived from the key."""
    identity = name_uuid(F.col("target"), F.col("body"), F.lit(v.CLASSIFYING), F.lit(agent))
    return found.select(
        F.concat(F.lit(v.ANNOTATION_BASE), identity).alias("ann_uri"),
        F.lit(task).alias("task_uri"),
        "target",
        "body",
        F.lit(v.CLASSIFYING).alias("motivated_by"),
        F.lit(agent).alias("agent_uri"),
        F.lit(v.AGENT_TYPE).alias("agent_type"),
        F.lit(graph or v.GRAPHS["ai"]).alias("g"),
        *keep,
    )


def annotation_rows(found: DataFrame, *, task: str, agent: str, graph: str | None = None) -> DataFrame:
    """One annotation per distinct (target, body)."""
    return annotation_columns(found.select("target", "body").distinct(), task=task, agent=agent, graph=graph)


def stored_annotations(quads: DataFrame, agent: str, graph: str | None = None) -> DataFrame:
    """(target, body, motivated_by, agent_uri) of classifying annotations an agent has stored, whatever their URI."""
    g = graph or v.GRAPHS["ai"]
    known = q.exists(
        q.instances(quads, v.ANNOTATION, "ann", graphs=g),
        q.pattern(quads, v.MOTIVATED_BY, "ann", value=v.CLASSIFYING, graphs=g),
        ["ann"],
    )
    made = q.pattern(quads, v.GENERATED, "activity", "ann", graphs=g)
    own = q.exists(made, q.pattern(quads, v.ASSOCIATED_WITH, "activity", value=agent, graphs=g), ["activity"])
    return (
        q.exists(known, own.select("ann"), ["ann"])
        .join(q.pattern(quads, v.HAS_TARGET, "ann", "target", graphs=g), "ann")
        .join(q.pattern(quads, v.HAS_BODY, "ann", "body", graphs=g), "ann")
        .select("target", "body", F.lit(v.CLASSIFYING).alias("motivated_by"), F.lit(agent).alias("agent_uri"))
    )


def only_new(new: DataFrame, existing: DataFrame, keys: Sequence[str] = ANNOTATION_KEY) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``, one row per key.

    ``existing`` is first reduced to the keys at hand, so a small batch never
    carries a large table through the anti-join. Of several new rows with one
    key the smallest stays, whatever the task order.
    """
    keys = list(keys)
    rest = [name for name in new.columns if name not in keys]
    if rest:
        single = (
            new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_rest")).select(*keys, "_rest.*")
        )
    else:
        single = new.distinct()
    hits = existing.select(*keys).join(single.select(*keys), keys, "left_semi")
    return single.join(hits, keys, "left_anti").select(*new.columns)


def with_no_match(fanned: DataFrame, replies: DataFrame) -> DataFrame:
    """(target, body): resolved classes, and the no-match marker for empty class lists."""
    resolved = fanned.where(F.col("uri").isNotNull()).select(
        F.col("decision").alias("target"), F.col("uri").alias("body")
    )
    none = replies.where(F.size("classes") == 0).select(
        F.col("decision").alias("target"), F.lit(v.NO_MATCH).alias("body")
    )
    return resolved.unionByName(none)


def output_containers(resources: DataFrame, task: str, base: str = v.CONTAINER_BASE) -> DataFrame:
    """(container_uri, uuid, resource): one container per processed resource of a task."""
    named = resources.select("resource").distinct().withColumn("uuid", name_uuid(F.lit(task), F.col("resource")))
    return named.select(F.concat(F.lit(base), "uuid").alias("container_uri"), "uuid", "resource")


def _unfold(rows: DataFrame, *quads: list[Column]) -> DataFrame:
    """Several quads per row in one pass over the rows."""
    structs = F.array(*[F.struct(*columns) for columns in quads])
    return rows.select(F.explode(structs).alias("q")).select("q.*")


def container_quads(containers: DataFrame, graph: str | None = None) -> DataFrame:
    g = graph or v.GRAPHS["data_containers"]
    uri = F.col("container_uri")
    return _unfold(
        containers,
        q.quad(g, uri, v.TYPE, q.term(F.lit(v.DATA_CONTAINER))),
        q.quad(g, uri, v.UUID, q.term(F.col("uuid"), "literal")),
        q.quad(g, uri, v.HAS_RESOURCE, q.term(F.col("resource"))),
    )


def annotation_quads(annotations: DataFrame) -> DataFrame:
    """Annotation and provenance activity as quads in the graph of the row, and one type quad for each agent."""
    g, uri = F.col("g"), F.col("ann_uri")
    activity = F.concat(F.lit(v.ACTIVITY_BASE), name_uuid(F.col("task_uri"), uri))
    agents = annotations.select("g", "agent_uri", "agent_type").distinct()
    typed = _unfold(agents, q.quad(g, F.col("agent_uri"), v.TYPE, q.term(F.col("agent_type"))))
    return _unfold(
        annotations,
        q.quad(g, uri, v.TYPE, q.term(F.lit(v.ANNOTATION))),
        q.quad(g, uri, v.HAS_TARGET, q.term(F.col("target"))),
        q.quad(g, uri, v.MOTIVATED_BY, q.term(F.col("motivated_by"))),
        q.quad(g, uri, v.HAS_BODY, q.term(F.col("body"))),
        q.quad(g, activity, v.TYPE, q.term(F.lit(v.ACTIVITY))),
        q.quad(g, activity, v.GENERATED, q.term(uri)),
        q.quad(g, activity, v.ASSOCIATED_WITH, q.term(F.col("agent_uri"))),
    ).unionByName(typed)


def direction_uri(direction: Column) -> Column:
    """URI of an impact direction, NULL for an unknown one."""
    uri = F.lit(None).cast("string")
    for name, value in v.IMPACT_URIS.items():
        uri = F.when(direction == name, F.lit(value)).otherwise(uri)
    return uri


def impact_quads(
    assessments: DataFrame, quads: DataFrame, *, agent: str | None = None, ai_graph: str | None = None
) -> DataFrame:
    """Quads that store (annotation, impact_direction).

    Only existing annotations without an impact body get one; of several
    verdicts for one annotation the first by concept and label counts, if those
    columns are given. Activities that generated the annotation are linked to
    the impact agent.
    """
    g = ai_graph or v.GRAPHS["ai"]
    agent = agent or v.AGENTS["impact_annotator"]
    order = [name for name in ("concept", "label", "impact_direction") if name in assessments.columns]
    verdicts = (
        assessments.groupBy("annotation")
        .agg(F.min_by("impact_direction", F.struct(*order)).alias("impact_direction"))
        .withColumn("impact", direction_uri(F.col("impact_direction")))
        .where(F.col("impact").isNotNull())
    )
    known = q.instances(quads, v.ANNOTATION, "annotation", graphs=g)
    assessed = q.pattern(quads, v.HAS_BODY, "annotation", value=list(v.IMPACT_URIS.values()), graphs=g)
    open_ = q.not_exists(q.exists(verdicts, known, ["annotation"]), assessed, ["annotation"])
    activities = q.exists(
        q.pattern(quads, v.GENERATED, "activity", "annotation", graphs=g),
        q.instances(quads, v.ACTIVITY, "activity", graphs=g),
        ["activity"],
    )
    stored = q.optional(open_, activities, ["annotation"])
    both = _unfold(
        stored,
        q.quad(g, F.col("annotation"), v.HAS_BODY, q.term(F.col("impact"))),
        q.quad(g, F.col("activity"), v.ASSOCIATED_WITH, q.term(F.lit(agent))),
    )
    return both.where(F.col("s").isNotNull()).distinct()
