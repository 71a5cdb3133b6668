"""Selection of job options, inputs and decisions to work on."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.functions.text import is_blank, parse_float
from conceptmill.operators import graph as q
from conceptmill.operators.skew import all_of, members_without, spread_join
from conceptmill.session import scratch_path
from conceptmill.operators.text import join_nonempty

# --- job options --------------------------------------------------------------


def task_codelists(quads: DataFrame) -> DataFrame:
    """(task, codelist): both links have to be in the same graph."""
    jobs = q.pattern(quads, v.PART_OF, "task", "job", g="g")
    codelists = q.pattern(quads, v.JOB_CODELIST, "job", "codelist", g="g")
    return q.first_value(jobs.join(codelists, ["g", "job"]), "task", "codelist")


def _of_task(quads: DataFrame, task: str) -> DataFrame:
    """Quads without the job links of other tasks, so one lookup stays small."""
    return quads.where((F.col("p") != v.PART_OF) | (F.col("s") == task))


def task_option(quads: DataFrame, predicate: str, name: str) -> DataFrame:
    """(task, option value), whatever the graphs."""
    jobs = q.pattern(quads, v.PART_OF, "task", "job")
    values = q.pattern(quads, predicate, "job", name)
    return q.first_value(jobs.join(values, "job"), "task", name)


def task_text_paths(quads: DataFrame) -> DataFrame:
    """(task, path, valid) for all tasks with a text property."""
    return task_option(quads, v.JOB_TEXT_PATH, "path").withColumn("valid", F.col("path").rlike("^https?://"))


def task_thresholds(quads: DataFrame, default: float = v.DEFAULT_THRESHOLD) -> DataFrame:
    """(task, threshold) for all tasks; no number falls back to the default."""
    tasks = q.pattern(quads, v.PART_OF, "task").distinct()
    options = task_option(quads, v.JOB_THRESHOLD, "text")
    return q.optional(tasks, options, ["task"]).select(
        "task", F.coalesce(parse_float(F.col("text")), F.lit(default)).alias("threshold")
    )


@dataclass(frozen=True)
class JobSettings:
    """The options of one task's job."""

    task: str
    codelist: str
    target_graph: str | None
    text_path: str | None
    threshold: float | None

    def require_target_graph(self) -> str:
        if not self.target_graph:
            raise RuntimeError(f"task {self.task} has no target graph")
        return self.target_graph


_OPTIONS = (v.JOB_CODELIST, v.JOB_TARGET_GRAPH, v.JOB_TEXT_PATH, v.JOB_THRESHOLD)


def job_settings(quads: DataFrame, task: str) -> JobSettings:
    """All options of a task's job from one small aggregation.

    A missing codelist is an error, and so is a text property that is no web URI.
    """
    jobs = q.rows(quads, v.PART_OF).where(F.col("s") == task)
    jobs = jobs.select(F.col("g").alias("job_graph"), F.col("o.value").alias("job"))
    options = q.rows(quads, _OPTIONS).select("g", F.col("s").alias("job"), "p", F.col("o.value").alias("value"))
    found = jobs.join(options, "job")

    def smallest(predicate: str, where=F.lit(True)):
        return F.min(F.when((F.col("p") == predicate) & where, F.col("value")))

    row = found.agg(
        smallest(v.JOB_CODELIST, F.col("g") == F.col("job_graph")).alias("codelist"),
        smallest(v.JOB_TARGET_GRAPH).alias("target_graph"),
        smallest(v.JOB_TEXT_PATH).alias("text_path"),
        parse_float(smallest(v.JOB_THRESHOLD)).alias("threshold"),
    ).first()
    if row["codelist"] is None:
        raise ValueError(f"task {task} has no codelist: its job needs one")
    path = row["text_path"]
    if path is not None and not path.startswith(("http://", "https://")):
        raise ValueError(f"text property of task {task} is not a URI: {path!r}")
    return JobSettings(task, row["codelist"], row["target_graph"], path, row["threshold"])


def shape_targets(quads: DataFrame) -> DataFrame:
    """Set of (task, kind, uri): target nodes and target classes of the job's shapes."""
    jobs = q.pattern(quads, v.PART_OF, "task", "job")
    shapes = q.pattern(quads, v.JOB_SHAPE, "job", "shape")
    targets = (
        q.rows(quads, [v.TARGET_NODE, v.TARGET_CLASS])
        .select(
            F.col("s").alias("shape"),
            F.when(F.col("p") == v.TARGET_NODE, F.lit("node")).otherwise(F.lit("class")).alias("kind"),
            F.col("o.value").alias("uri"),
        )
        .distinct()
    )
    return jobs.join(shapes, "job").join(targets, "shape").select("task", "kind", "uri").distinct()


def shape_targets_of_task(quads: DataFrame, task: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Target nodes and target classes with a ``uri`` column, each None without any."""
    shapes = shape_targets(_of_task(quads, task)).where(F.col("task") == task)
    nodes = shapes.where("kind = 'node'").select("uri")
    classes = shapes.where("kind = 'class'").select("uri")
    return None if nodes.isEmpty() else nodes, None if classes.isEmpty() else classes


# --- inputs -------------------------------------------------------------------


def task_inputs(quads: DataFrame) -> DataFrame:
    """Distinct (task, resource) of the tasks' input containers."""
    containers = q.pattern(quads, v.INPUT_CONTAINER, "task", "container")
    resources = q.pattern(quads, v.HAS_RESOURCE, "container", "resource")
    return containers.join(resources, "container").select("task", "resource").distinct()


def inputs_of_task(quads: DataFrame, task: str) -> DataFrame:
    own = quads.where((F.col("p") != v.INPUT_CONTAINER) | (F.col("s") == task))
    return task_inputs(own).select("resource")


def input_violations(quads: DataFrame) -> DataFrame:
    """(task, resource) of inputs that are not typed as an expression."""
    return q.not_exists(
        task_inputs(quads), q.instances(quads, v.EXPRESSION, "resource"), ["resource"]
    )


def valid_inputs_of_task(quads: DataFrame, task: str) -> DataFrame | None:
    """The inputs of the task, None when it has none; raises when one is no expression.

    The error says how many there are and where all of them are written.
    """
    own = quads.where((F.col("p") != v.INPUT_CONTAINER) | (F.col("s") == task))
    inputs = task_inputs(own).select("resource")
    if inputs.isEmpty():
        return None
    wrong = input_violations(own).select("resource")
    n, first = wrong.agg(F.count("resource"), F.min("resource")).first()
    if n:
        path = scratch_path(quads.sparkSession, "input-violations")
        wrong.write.parquet(path)
        raise RuntimeError(f"{n} inputs of task {task} not found to be expressions, first {first}; all of them: {path}")
    return inputs


def restrict_to_inputs(decisions: DataFrame, inputs: DataFrame, column: str) -> DataFrame:
    """Keep decisions that are inputs. A task without inputs has no restriction."""
    return q.exists(decisions, inputs.select(F.col("resource").alias(column)), [column])


# --- existing annotations -----------------------------------------------------


def _annotation_marks(quads: DataFrame, graphs: Iterable[str], g: str = "g") -> DataFrame:
    """(g, ann, mark): the subject is typed as annotation, or motivated by classifying."""
    found = quads.where(F.col("g").isin(list(graphs)) & F.col("p").isin(v.TYPE, v.MOTIVATED_BY))
    typed = (F.col("p") == v.TYPE) & (F.col("o.value") == v.ANNOTATION)
    motive = (F.col("p") == v.MOTIVATED_BY) & (F.col("o.value") == v.CLASSIFYING)
    return found.where((typed | motive) & (F.col("o.kind") == "uri")).select(
        F.col("g").alias(g), F.col("s").alias("ann"), F.when(F.col("p") == v.TYPE, F.lit(0)).otherwise(F.lit(1)).alias("mark")
    )


def classifying_annotations(quads: DataFrame, graphs: Iterable[str], g: str = "g") -> DataFrame:
    """(g, ann) typed as annotation and motivated by classifying, in the same graph."""
    return all_of(_annotation_marks(quads, graphs, g), [g, "ann"], [F.col("mark") == 0, F.col("mark") == 1])


def scheme_concepts(
    quads: DataFrame, scheme: str, *, graph: str | None = None, predicates=(v.IN_SCHEME, v.FOR_SCHEME)
) -> DataFrame:
    """(g, concept) tied to the scheme."""
    return q.pattern(quads, predicates, "concept", g="g", value=scheme, graphs=graph)


def classified_targets(
    quads: DataFrame, scheme: str, graphs: Iterable[str], *, scheme_graph: str = "same", public: str | None = None,
    no_match_counts_as_done: bool = False,
) -> DataFrame:
    """Distinct ``target`` with a classifying annotation for the scheme.

    ``scheme_graph='same'`` looks the concept up in the graph of the annotation
    itself, ``'public'`` in the public graph. With ``no_match_counts_as_done``
    the no-match marker counts as a concept of every scheme.
    """
    graphs = sorted(set(graphs))
    bodies = q.pattern(quads, v.HAS_BODY, "ann", "concept", g="g", graphs=graphs)
    if scheme_graph == "same":
        concepts = scheme_concepts(quads.where(F.col("g").isin(graphs)), scheme)
        on = ["g", "concept"]
    else:
        concepts = scheme_concepts(
            quads, scheme, graph=public or v.GRAPHS["public"], predicates=v.IN_SCHEME
        ).select("concept")
        on = ["concept"]
    hits = spread_join(bodies, concepts.distinct(), on, "left_semi", spread=["ann"]).select("g", "ann")
    if no_match_counts_as_done:
        hits = hits.unionByName(bodies.where(F.col("concept") == v.NO_MATCH).select("g", "ann"))
    marks = _annotation_marks(quads, graphs).unionByName(hits.withColumn("mark", F.lit(2)))
    done = all_of(marks, ["g", "ann"], [F.col("mark") == i for i in range(3)])
    targets = q.pattern(quads, v.HAS_TARGET, "ann", "target", g="g", graphs=graphs)
    return q.exists(targets, done, ["g", "ann"]).select("target").distinct()


# --- decisions to work on -----------------------------------------------------


def target_decisions(
    quads: DataFrame,
    *,
    target_graph: str | None = None,
    nodes: DataFrame | None = None,
    classes: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """``decision`` URIs a job may work on: nodes, instances of classes, or all expressions.

    ``nodes`` is a DataFrame with a ``uri`` column; nodes are taken as they are,
    without a type check. ``classes`` is a list or such a DataFrame.
    """
    parts = []
    if nodes is not None:
        parts.append(nodes.select(F.col("uri").alias("decision")))
    if isinstance(classes, DataFrame):
        typed = (
            q.rows(quads, v.TYPE, graphs=target_graph)
            .where(F.col("o.kind") == "uri")
            .select(F.col("s").alias("decision"), F.col("o.value").alias("uri"))
        )
        parts.append(spread_join(typed, classes, ["uri"], "left_semi", spread=["decision"]).select("decision"))
    elif classes or nodes is None:
        wanted = list(classes) if classes else v.EXPRESSION
        parts.append(q.instances(quads, wanted, "decision", graphs=target_graph))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def unannotated_decisions(
    quads: DataFrame,
    scheme: str,
    *,
    target_graph: str | None = None,
    nodes: DataFrame | None = None,
    classes: Iterable[str] | DataFrame | None = None,
    inputs: DataFrame | None = None,
    ai_graph: str | None = None,
    no_match_counts_as_done: bool = False,
) -> DataFrame:
    """Distinct decisions that have no classifying annotation for the scheme yet."""
    targets = target_decisions(quads, target_graph=target_graph, nodes=nodes, classes=classes)
    if inputs is not None:
        targets = restrict_to_inputs(targets, inputs, "decision")
    graphs = [ai_graph or v.GRAPHS["ai"]] + ([target_graph] if target_graph else [])
    done = classified_targets(quads, scheme, graphs, no_match_counts_as_done=no_match_counts_as_done)
    return members_without(targets, done.withColumnRenamed("target", "decision"), "decision")


def with_text_properties(decisions: DataFrame, quads: DataFrame, on: list[str], graphs=None) -> DataFrame:
    """Left-join the text properties; several values of one give several rows."""
    g = "g" if "g" in on else None
    for name, predicate in v.TEXT_PROPERTIES.items():
        values = q.pattern(quads, predicate, "decision", name, g=g, graphs=graphs)
        decisions = q.optional(decisions, values, on)
    return decisions


def unannotated_with_text(
    quads: DataFrame,
    scheme: str,
    target_graph: str,
    *,
    inputs: DataFrame | None = None,
    ai_graph: str | None = None,
    public_graph: str | None = None,
    one_row_per_decision: bool = False,
) -> DataFrame:
    """(decision, text) of expressions in the target graph without an annotation.

    The concept's scheme is looked up in the public graph. Each combination of
    text values is one row, unless ``one_row_per_decision`` joins all values.
    """
    expressions = q.instances(quads, v.EXPRESSION, "decision", graphs=target_graph)
    if inputs is not None:
        expressions = restrict_to_inputs(expressions, inputs, "decision")
    done = classified_targets(
        quads, scheme, [target_graph, ai_graph or v.GRAPHS["ai"]], scheme_graph="public", public=public_graph
    )
    open_ = members_without(expressions, done.withColumnRenamed("target", "decision"), "decision")
    if one_row_per_decision:
        texts = text_per_decision(quads.where(F.col("g") == target_graph), open_)
        return q.optional(open_, texts, ["decision"]).select(
            "decision", F.coalesce("text", F.lit("")).alias("text")
        )
    # Decisions are distinct and a graph is a set, so the combinations are distinct too.
    combined = with_text_properties(open_, quads, ["decision"], graphs=target_graph)
    return combined.select("decision", join_nonempty(*v.TEXT_PROPERTIES).alias("text"))


def text_per_decision(quads: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """(decision, text): all values of all text properties, in property order.

    With ``decisions`` only their texts are read into the aggregation.
    """
    found = q.rows(quads, list(v.TEXT_PROPERTIES.values())).where(F.col("o.value") != "")
    rank = F.lit(None).cast("int")
    for place, predicate in enumerate(v.TEXT_PROPERTIES.values()):
        rank = F.when(F.col("p") == predicate, F.lit(place)).otherwise(rank)
    pieces = found.select(
        F.col("s").alias("decision"), F.struct(rank.alias("place"), F.col("o.value").alias("value")).alias("piece")
    )
    if decisions is not None:
        pieces = q.exists(pieces, decisions.select("decision"), ["decision"])
    ordered = F.array_sort(F.collect_set("piece"))
    return pieces.groupBy("decision").agg(
        F.array_join(F.transform(ordered, lambda x: x["value"]), "\n").alias("text")
    )


def annotated_with_classes(
    quads: DataFrame,
    scheme: str,
    *,
    inputs: DataFrame | None = None,
    names: DataFrame | None = None,
    ai_graph: str | None = None,
    public_graph: str | None = None,
    one_row_per_decision: bool = False,
) -> DataFrame:
    """(decision, classes, text) of annotated expressions, classes in URI order.

    Like the underlying graph pattern, there is a row per graph and per
    combination of text and language values, unless ``one_row_per_decision``.
    ``names`` (uri, name) replaces class URIs by labels before texts are joined;
    URIs without a name stay.
    """
    ai, public = ai_graph or v.GRAPHS["ai"], public_graph or v.GRAPHS["public"]
    concepts = q.exists(
        q.instances(quads, v.CONCEPT, "body", graphs=public),
        scheme_concepts(quads, scheme, graph=public, predicates=v.IN_SCHEME).select(F.col("concept").alias("body")),
        ["body"],
    )
    bodies = q.pattern(quads, v.HAS_BODY, "ann", "body", graphs=ai)
    bodies = spread_join(bodies, concepts, ["body"], "left_semi", spread=["ann"])
    bodies = q.exists(bodies, classifying_annotations(quads, [ai]), ["ann"])
    targets = q.pattern(quads, v.HAS_TARGET, "ann", "decision", graphs=ai)
    pairs = targets.join(bodies, "ann").select("decision", "body").distinct()
    if names is not None:
        named = names.withColumnRenamed("uri", "body")
        pairs = spread_join(pairs, named, ["body"], "left", spread=["decision"])
        pairs = pairs.withColumn("name", F.coalesce("name", "body"))
    else:
        pairs = pairs.withColumn("name", F.col("body"))
    classes = pairs.groupBy("decision").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("body", "name"))), lambda x: x["name"]).alias("classes")
    )
    expressions = q.instances(quads, v.EXPRESSION, "decision", g="g")
    if inputs is not None:
        expressions = restrict_to_inputs(expressions, inputs, "decision")
    if one_row_per_decision:
        labelled = classes.join(expressions.select("decision").distinct(), "decision", "left_semi")
        texts = text_per_decision(quads, labelled)
        return q.optional(labelled, texts, ["decision"]).select(
            "decision", "classes", F.coalesce("text", F.lit("")).alias("text")
        )
    rows = expressions.join(classes, "decision")
    rows = with_text_properties(rows, quads, ["g", "decision"])
    languages = q.pattern(quads, v.DCT_LANGUAGE, "decision", "language", g="g")
    rows = q.optional(rows, languages, ["g", "decision"])
    return rows.select("decision", "classes", join_nonempty(*v.TEXT_PROPERTIES).alias("text"))


def unassessed_annotations(quads: DataFrame, ai_graph: str) -> DataFrame:
    """Classifying annotations without an impact body."""
    assessed = q.pattern(quads, v.HAS_BODY, "ann", value=list(v.IMPACT_URIS.values()), graphs=ai_graph)
    return members_without(classifying_annotations(quads, [ai_graph]), assessed, "ann")


def assessable_expressions(
    quads: DataFrame,
    task: str,
    scheme: str,
    target_graph: str | None,
    *,
    graphs: dict[str, str] | None = None,
) -> DataFrame:
    """(expression, lang, work, content) of task inputs with an annotation still to assess."""
    if not target_graph:
        raise ValueError(f"task {task} has no target graph")
    roles = graphs or v.GRAPHS
    containers = q.rows(quads, v.INPUT_CONTAINER, graphs=roles["jobs"]).where(F.col("s") == task)
    listed = (
        q.pattern(quads, v.HAS_RESOURCE, "container", "expression", graphs=roles["data_containers"])
        .join(containers.select(F.col("o.value").alias("container")), "container")
        .groupBy("expression")
        .agg(F.count(F.lit(1)).cast("int").alias("listed"))
    )
    bodies = q.pattern(quads, v.HAS_BODY, "ann", "concept", graphs=roles["ai"])
    concepts = scheme_concepts(quads, scheme, graph=roles["public"], predicates=v.IN_SCHEME).select("concept")
    bodies = spread_join(bodies, concepts, ["concept"], "left_semi", spread=["ann"])
    open_ = q.exists(unassessed_annotations(quads, roles["ai"]), bodies, ["ann"])
    targets = q.pattern(quads, v.HAS_TARGET, "ann", "expression", graphs=roles["ai"])
    open_targets = q.exists(targets, open_, ["ann"]).select("expression").distinct()

    wanted = q.exists(listed, open_targets, ["expression"])
    wanted = q.exists(wanted, q.instances(quads, v.EXPRESSION, "expression", graphs=target_graph), ["expression"])
    contents = q.pattern(quads, v.CONTENT, "expression", "content", graphs=target_graph)
    # A content value repeats once per container that lists the expression.
    texts = wanted.join(contents, "expression").groupBy("expression", "listed").agg(
        F.array_sort(F.collect_list("content")).alias("values")
    ).select(
        "expression",
        F.array_join(
            F.flatten(F.transform("values", lambda x: F.array_repeat(x, F.col("listed")))), ""
        ).alias("content"),
    )
    languages = q.pattern(quads, v.LANGUAGE, "expression", "lang", graphs=target_graph)
    works = spread_join(
        q.pattern(quads, v.REALIZED_BY, "work", "expression", graphs=target_graph),
        q.instances(quads, v.WORK, "work", graphs=target_graph),
        ["work"],
        "left_semi",
        spread=["expression"],
    )
    return (
        texts.join(languages, "expression")
        .join(works, "expression")
        .select("expression", "lang", "work", "content")
    )


def policy_labels(
    quads: DataFrame, scheme: str, *, ai_graph: str | None = None, public_graph: str | None = None
) -> DataFrame:
    """(expression, annotation, concept, label) of all classifying annotations for the scheme."""
    ai, public = ai_graph or v.GRAPHS["ai"], public_graph or v.GRAPHS["public"]
    concepts = scheme_concepts(quads, scheme, graph=public, predicates=v.IN_SCHEME).select("concept")
    concepts = q.exists(concepts, q.instances(quads, v.CONCEPT, "concept", graphs=public), ["concept"])
    concepts = q.not_exists(concepts, q.instances(quads, v.NO_MATCH_CLASS, "concept", graphs=ai), ["concept"])
    labels = q.pattern(quads, v.PREF_LABEL, "concept", "label", graphs=public).join(concepts, "concept")
    bodies = q.pattern(quads, v.HAS_BODY, "annotation", "concept", graphs=ai)
    annotations = classifying_annotations(quads, [ai]).select(F.col("ann").alias("annotation"))
    targets = q.pattern(quads, v.HAS_TARGET, "annotation", "expression", graphs=ai)
    labelled = spread_join(bodies, labels, ["concept"], "inner", spread=["annotation"])
    return (
        q.exists(labelled, annotations, ["annotation"])
        .join(targets, "annotation")
        .select("expression", "annotation", "concept", "label")
    )


def skip_reasons(decisions: DataFrame, text: str = "text", classes: str | None = None) -> DataFrame:
    """Add ``skip_reason``: NULL for rows to process."""
    reason = F.when(is_blank(F.col(text)), F.lit("blank text"))
    if classes:
        reason = reason.when(F.coalesce(F.size(classes), F.lit(0)) <= 0, F.lit("no classes"))
    return decisions.withColumn("skip_reason", reason)
