"""Selection of options, inputs and decisions on small graphs."""

import pytest
from small_tables import lit, rows

from conceptmill import vocab as v
from conceptmill.operators import graph as q
from conceptmill.operators import labels as lab
from conceptmill.operators import selection as sel

AI, PUBLIC, JOBS, BOX = (v.GRAPHS[k] for k in ("ai", "public", "jobs", "data_containers"))
DATA = "g:data"
TASK, JOB, SCHEME = "t:1", "j:1", "s:goals"


def expression(name, content="text", g=DATA):
    return [(g, name, v.TYPE, v.EXPRESSION), (g, name, v.CONTENT, lit(content))]


def annotation(name, target, *bodies, g=AI, motive=v.CLASSIFYING):
    return [
        (g, name, v.TYPE, v.ANNOTATION), (g, name, v.HAS_TARGET, target), (g, name, v.MOTIVATED_BY, motive),
        *[(g, name, v.HAS_BODY, b) for b in bodies],
    ]


def concept(name, label, g=PUBLIC, scheme=SCHEME):
    return [(g, name, v.TYPE, v.CONCEPT), (g, name, v.IN_SCHEME, scheme), (g, name, v.PREF_LABEL, lit(label, "en"))]


def job(**options):
    rows_ = [(JOBS, TASK, v.PART_OF, JOB), (JOBS, JOB, v.JOB_CODELIST, SCHEME)]
    return rows_ + [(JOBS, JOB, getattr(v, k), o) for k, o in options.items()]


def decisions(df):
    return [r[0] for r in rows(df)]


# --- job options ---


def test_settings(make_quads):
    quads = make_quads(*job(JOB_TARGET_GRAPH=DATA, JOB_THRESHOLD=lit(" 0.7 "), JOB_TEXT_PATH="http://x/p"))
    assert sel.job_settings(quads, TASK) == sel.JobSettings(TASK, SCHEME, DATA, "http://x/p", 0.7)


def test_settings_without_options(make_quads):
    assert sel.job_settings(make_quads(*job()), TASK) == sel.JobSettings(TASK, SCHEME, None, None, None)


def test_codelist_has_to_be_in_the_graph_of_the_task(make_quads):
    quads = make_quads((JOBS, TASK, v.PART_OF, JOB), ("g:other", JOB, v.JOB_CODELIST, SCHEME))
    with pytest.raises(ValueError, match=TASK):
        sel.job_settings(quads, TASK)
    assert rows(sel.task_codelists(quads)) == []


def test_text_path_has_to_be_a_uri(make_quads):
    with pytest.raises(ValueError, match="not a URI"):
        sel.job_settings(make_quads(*job(JOB_TEXT_PATH=lit("} DROP"))), TASK)


def test_threshold_that_is_no_number_is_ignored(make_quads):
    quads = make_quads(*job(JOB_THRESHOLD=lit("abc")))
    assert sel.job_settings(quads, TASK).threshold is None
    assert rows(sel.task_thresholds(quads, 0.3)) == [(TASK, 0.3)]


def test_missing_target_graph_is_an_error(make_quads):
    with pytest.raises(RuntimeError):
        sel.job_settings(make_quads(*job()), TASK).require_target_graph()


def test_shape_targets(make_quads):
    quads = make_quads(
        *job(JOB_SHAPE="sh:1"), (JOBS, JOB, v.JOB_SHAPE, "sh:2"), (JOBS, JOB, v.JOB_SHAPE, "sh:empty"),
        (PUBLIC, "sh:1", v.TARGET_NODE, "e:1"), (DATA, "sh:1", v.TARGET_NODE, "e:1"), (PUBLIC, "sh:2", v.TARGET_CLASS, "c:1"),
    )
    nodes, classes = sel.shape_targets_of_task(quads, TASK)
    assert rows(nodes) == [("e:1",)] and rows(classes) == [("c:1",)]
    nodes, classes = sel.shape_targets_of_task(make_quads(*job()), TASK)
    assert nodes is None and classes is None


def test_classes_of_shapes_are_uris(make_quads):
    quads = make_quads(
        *job(JOB_SHAPE="sh:1"), (PUBLIC, "sh:1", v.TARGET_CLASS, v.EXPRESSION), (PUBLIC, "sh:1", v.TARGET_CLASS, v.WORK),
        *expression("e:1"), (DATA, "w:1", v.TYPE, v.WORK), (DATA, "x:1", v.TYPE, "c:other"),
        (DATA, "y:1", v.TYPE, lit(v.WORK)),
    )
    _, classes = sel.shape_targets_of_task(quads, TASK)
    assert decisions(sel.unannotated_decisions(quads, SCHEME, target_graph=DATA, classes=classes)) == ["e:1", "w:1"]


# --- inputs ---


def inputs_of(*resources):
    return [(JOBS, TASK, v.INPUT_CONTAINER, "b:1"), *[(BOX, "b:1", v.HAS_RESOURCE, r) for r in resources]]


def test_inputs(make_quads):
    quads = make_quads(*expression("e:1"), *expression("e:2"), *inputs_of("e:1"))
    assert decisions(sel.valid_inputs_of_task(quads, TASK)) == ["e:1"]
    assert sel.valid_inputs_of_task(quads, "t:none") is None


def test_input_that_is_no_expression_is_an_error(make_quads):
    quads = make_quads(*expression("e:1"), *inputs_of("e:1", "x:9"))
    with pytest.raises(RuntimeError, match="x:9"):
        sel.valid_inputs_of_task(quads, TASK)


# --- open decisions ---


def test_annotated_decision_is_left_out(make_quads):
    quads = make_quads(
        *expression("e:1"), *expression("e:2"), *annotation("a:1", "e:2", "c:1"), (AI, "c:1", v.IN_SCHEME, SCHEME)
    )
    assert decisions(sel.unannotated_decisions(quads, SCHEME)) == ["e:1"]
    assert decisions(sel.unannotated_decisions(quads, SCHEME, target_graph=DATA)) == ["e:1"]
    assert decisions(sel.unannotated_decisions(quads, "s:other")) == ["e:1", "e:2"]


def test_scheme_in_another_graph_does_not_count(make_quads):
    quads = make_quads(*expression("e:1"), *annotation("a:1", "e:1", "c:1"), *concept("c:1", "One"))
    assert decisions(sel.unannotated_decisions(quads, SCHEME)) == ["e:1"]
    # The variant with text looks the scheme up in the public graph.
    assert decisions(sel.unannotated_with_text(quads, SCHEME, DATA)) == []


def test_other_motive_does_not_count(make_quads):
    quads = make_quads(
        *expression("e:1"), *annotation("a:1", "e:1", "c:1", motive=v.OA + "linking"), (AI, "c:1", v.IN_SCHEME, SCHEME)
    )
    assert decisions(sel.unannotated_decisions(quads, SCHEME)) == ["e:1"]


def test_alternative_scheme_link_counts(make_quads):
    quads = make_quads(*expression("e:1"), *annotation("a:1", "e:1", "c:1"), (AI, "c:1", v.FOR_SCHEME, SCHEME))
    assert decisions(sel.unannotated_decisions(quads, SCHEME)) == []


def test_no_match_only_counts_on_request(make_quads):
    quads = make_quads(*expression("e:1"), *annotation("a:1", "e:1", v.NO_MATCH))
    assert decisions(sel.unannotated_decisions(quads, SCHEME)) == ["e:1"]
    assert decisions(sel.unannotated_decisions(quads, SCHEME, no_match_counts_as_done=True)) == []


def test_annotation_parts_in_two_graphs_do_not_count(make_quads):
    whole = annotation("a:1", "e:1", "c:1")
    split = [(DATA, *r[1:]) if r[2] == v.MOTIVATED_BY else r for r in whole]
    quads = make_quads(*expression("e:1"), *split, (AI, "c:1", v.IN_SCHEME, SCHEME))
    assert decisions(sel.unannotated_decisions(quads, SCHEME, target_graph=DATA)) == ["e:1"]


def test_nodes_are_taken_without_a_type_check(spark, make_quads):
    quads = make_quads(*expression("e:1"), (DATA, "w:1", v.TYPE, v.WORK))
    nodes = spark.createDataFrame([("x:9",)], "uri string")
    assert decisions(sel.unannotated_decisions(quads, SCHEME, nodes=nodes)) == ["x:9"]
    assert decisions(sel.unannotated_decisions(quads, SCHEME, nodes=nodes, classes=[v.WORK])) == ["w:1", "x:9"]
    assert decisions(sel.unannotated_decisions(quads, SCHEME, classes=[v.WORK])) == ["w:1"]
    assert decisions(sel.unannotated_decisions(quads, SCHEME)) == ["e:1"]


def test_text_combinations(make_quads):
    quads = make_quads(
        *expression("e:1", "body"), (DATA, "e:1", v.TITLE, lit("A")), (DATA, "e:1", v.TITLE, lit("B")),
        (DATA, "e:1", v.DESCRIPTION, lit("")), ("g:other", "e:1", v.TITLE, lit("C")),
    )
    assert rows(sel.unannotated_with_text(quads, SCHEME, DATA)) == [("e:1", "A\nbody"), ("e:1", "B\nbody")]
    assert rows(sel.unannotated_with_text(quads, SCHEME, DATA, one_row_per_decision=True)) == [("e:1", "A\nB\nbody")]


# --- annotated decisions ---


def labelled_graph(make_quads, *more):
    return make_quads(
        *expression("e:1"), *expression("e:2"), *concept("c:1", "One"), *concept("c:2", "Two"), *concept("d:1", "Other", scheme="s:x"),
        *annotation("a:1", "e:1", "c:1"), *annotation("a:2", "e:1", "c:2"), *annotation("a:3", "e:2", "d:1"), *more,
    )


def test_classes_of_the_scheme_only(make_quads):
    got = sel.annotated_with_classes(labelled_graph(make_quads), SCHEME)
    assert rows(got) == [("e:1", ["c:1", "c:2"], "text")]


def test_class_names(make_quads):
    quads = labelled_graph(make_quads)
    names = lab.uri_labels(lab.codelist_entries(quads, SCHEME))
    got = sel.annotated_with_classes(quads, SCHEME, names=names, one_row_per_decision=True)
    assert rows(got) == [("e:1", ["One", "Two"], "text")]


def test_languages_and_graphs_multiply_rows(make_quads):
    quads = labelled_graph(
        make_quads, (DATA, "e:1", v.DCT_LANGUAGE, "l:a"), (DATA, "e:1", v.DCT_LANGUAGE, "l:b"), ("g:2", "e:1", v.TYPE, v.EXPRESSION)
    )
    assert rows(sel.annotated_with_classes(quads, SCHEME), "text") == [("",), ("text",), ("text",)]


# --- impact ---


def impact_graph(make_quads, *more):
    return make_quads(
        *job(JOB_TARGET_GRAPH=DATA), *inputs_of("e:1", "e:2"), *expression("e:1", "b"), (DATA, "e:1", v.CONTENT, lit("a")),
        *expression("e:2"), *concept("c:1", "One"), *annotation("a:1", "e:1", "c:1"),
        *[(DATA, e, v.LANGUAGE, "l:en") for e in ("e:1", "e:2")], (DATA, "w:1", v.TYPE, v.WORK),
        *[(DATA, "w:1", v.REALIZED_BY, e) for e in ("e:1", "e:2")], *more,
    )


def test_assessable(make_quads):
    got = sel.assessable_expressions(impact_graph(make_quads), TASK, SCHEME, DATA)
    assert rows(got, "expression", "lang", "work", "content") == [("e:1", "l:en", "w:1", "ab")]


def test_content_repeats_per_container(make_quads):
    quads = impact_graph(make_quads, (JOBS, TASK, v.INPUT_CONTAINER, "b:2"), (BOX, "b:2", v.HAS_RESOURCE, "e:1"))
    assert rows(sel.assessable_expressions(quads, TASK, SCHEME, DATA), "content") == [("aabb",)]


def test_assessed_annotation_is_done(make_quads):
    quads = impact_graph(make_quads, (AI, "a:1", v.HAS_BODY, v.IMPACT_URIS["uncertain"]))
    assert rows(sel.assessable_expressions(quads, TASK, SCHEME, DATA)) == []
    # The labels of the expression are still listed.
    assert rows(sel.policy_labels(quads, SCHEME)) == [("e:1", "a:1", "c:1", "One")]


def test_policy_labels_in_every_language_without_no_match(make_quads):
    quads = impact_graph(
        make_quads, (PUBLIC, "c:1", v.PREF_LABEL, lit("Een", "nl")), *concept("c:9", "None"),
        *annotation("a:9", "e:2", "c:9"), (AI, "c:9", v.TYPE, v.NO_MATCH_CLASS),
    )
    assert rows(sel.policy_labels(quads, SCHEME), "annotation", "label") == [("a:1", "Een"), ("a:1", "One")]


def test_impact_needs_a_target_graph(make_quads):
    with pytest.raises(ValueError):
        sel.assessable_expressions(impact_graph(make_quads), TASK, SCHEME, None)


def test_ask(make_quads):
    quads = make_quads(*expression("e:1"))
    assert q.ask(q.instances(quads, v.EXPRESSION, "s"))
    assert not q.ask(q.instances(quads, v.WORK, "s"))
    # A literal with the same text is not the class.
    assert not q.ask(q.instances(make_quads((DATA, "e:1", v.TYPE, lit(v.EXPRESSION))), v.EXPRESSION, "s"))
