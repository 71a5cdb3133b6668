"""Whole jobs with stand-in models, writes and streams."""

import datetime
import json
import time

import pytest
from small_tables import lit, rows
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_selection import DATA, SCHEME, TASK, annotation, concept, expression, impact_graph, inputs_of, job

import test_jobs
from conceptmill import vocab as v
from conceptmill.operators import classifier as clf
from conceptmill.operators import model_calls as calls
from conceptmill.operators import model_metadata as meta
from conceptmill.operators import selection as sel
from conceptmill.operators import writes as wr
from conceptmill.plans import jobs
from conceptmill.sources.journal import ReplyJournal
from conceptmill.sources import quads as src
from conceptmill.sources import results_json, settings
from conceptmill.streaming import incremental as inc

cloudpickle.register_pickle_by_value(test_jobs)
AI = v.GRAPHS["ai"]


@pytest.fixture(scope="module")
def prompts(spark):
    return spark.createDataFrame([], "scheme string, system_message string, user_message string")


def decision_graph(make_quads, *more):
    return make_quads(
        *job(JOB_TARGET_GRAPH=DATA), *concept("c:1", "Clean Energy"), *concept("c:2", "Climate Action"),
        *expression("e:1", "about energy"), *expression("e:2", "about climate"), *expression("e:3", "about nothing"),
        *expression("e:4", " \xa0\n"), *more,
    )


def keyword_model():
    def answer(system, user):
        text = user[user.index("DECISION TEXT"):]
        found = [label for word, label in (("energy", "clean_energy"), ("climate", "Climate"), ("climate", "Weather")) if f"about {word}" in text]
        return "```json\n" + json.dumps({"designated_classes": found}) + "\n```"

    return answer


def test_batch_annotation(make_quads, prompts):
    quads = decision_graph(make_quads)
    result = jobs.batch_model_annotation(quads, TASK, factory=keyword_model, prompts=prompts)
    assert rows(result.annotations, "target", "body") == [("e:1", "c:1"), ("e:2", "c:2"), ("e:3", v.NO_MATCH)]
    # The blank decision is skipped, the one without a match has a container too.
    assert rows(result.containers, "resource") == [("e:1",), ("e:2",), ("e:3",)]
    assert {r["agent_uri"] for r in result.annotations.collect()} == {v.AGENTS["model_annotator"]}
    assert result.failed.isEmpty()


def test_second_run_writes_nothing_new(spark, make_quads, prompts, tmp_path):
    path = str(tmp_path / "store")
    scheme_in_ai = [(AI, "c:1", v.IN_SCHEME, SCHEME), (AI, "c:2", v.IN_SCHEME, SCHEME)]
    src.write_quads(decision_graph(make_quads, *scheme_in_ai), path)
    for expected_open in (["e:1", "e:2", "e:3", "e:4"], ["e:3", "e:4"], ["e:3", "e:4"]):
        quads = src.read_quads(spark, path)
        assert [r[0] for r in rows(sel.unannotated_decisions(quads, SCHEME, target_graph=DATA))] == expected_open
        result = jobs.batch_model_annotation(quads, TASK, factory=keyword_model, prompts=prompts)
        before = quads.count()
        src.append_quads(result.quads(), path)
    assert src.read_quads(spark, path).count() == before


def test_annotations_under_other_uris_are_not_made_again(make_quads, prompts):
    agent = v.AGENTS["model_annotator"]
    foreign = [
        (AI, "f:1", v.TYPE, v.ANNOTATION), (AI, "f:1", v.MOTIVATED_BY, v.CLASSIFYING), (AI, "f:1", v.HAS_TARGET, "e:1"),
        (AI, "f:1", v.HAS_BODY, "c:1"), (AI, "act:1", v.GENERATED, "f:1"), (AI, "act:1", v.ASSOCIATED_WITH, agent),
        (AI, "f:2", v.TYPE, v.ANNOTATION), (AI, "f:2", v.MOTIVATED_BY, v.CLASSIFYING), (AI, "f:2", v.HAS_TARGET, "e:2"),
        (AI, "f:2", v.HAS_BODY, "c:2"), (AI, "act:2", v.GENERATED, "f:2"), (AI, "act:2", v.ASSOCIATED_WITH, "agent:other"),
    ]
    result = jobs.batch_model_annotation(decision_graph(make_quads, *foreign), TASK, factory=keyword_model, prompts=prompts)
    assert rows(result.annotations, "target") == [("e:2",), ("e:3",)]
    agents = wr.annotation_quads(result.annotations).where(F.col("s") == agent)
    assert agents.count() == 1


def test_stored_replies_are_not_asked_again(spark, make_quads, prompts, tmp_path):
    store, quads = str(tmp_path / "replies"), decision_graph(make_quads)

    def half_broken():
        answer = keyword_model()

        def call(system, user):
            if "about climate" in user:
                raise RuntimeError("down")
            return answer(system, user)

        return call

    def never_for_energy():
        answer = keyword_model()

        def call(system, user):
            assert "about energy" not in user and "about nothing" not in user
            return answer(system, user)

        return call

    options = {"prompts": prompts, "store": store, "pause_seconds": 0}
    with pytest.raises(RuntimeError, match="usable replies are in"):
        jobs.batch_model_annotation(quads, TASK, factory=half_broken, attempts=1, **options)
    result = jobs.batch_model_annotation(quads, TASK, factory=never_for_energy, **options)
    assert rows(result.annotations, "target", "body") == [("e:1", "c:1"), ("e:2", "c:2"), ("e:3", v.NO_MATCH)]


def test_chunks_and_the_rate_of_a_job(spark, monkeypatch):
    monkeypatch.setattr(jobs, "CHUNK_ROWS", 3)
    requests = spark.createDataFrame([(f"r{i}", "s", f"u{i}") for i in range(20)], "id string, system_message string, user_message string")
    def parse(df):
        return df.withColumn("parse_error", F.lit(None).cast("string"))

    begun = time.time()
    answered, bad = jobs.ask_model(requests, lambda: lambda system, user: user[1:], parse, max_callers=2, calls_per_second=40)
    assert rows(answered, "id", "raw") == sorted((f"r{i}", str(i)) for i in range(20)) and bad.isEmpty()
    assert time.time() - begun >= 19 / 40


def test_many_tasks_keep_the_rate_of_the_job(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(jobs, "CHUNK_ROWS", 5)
    requests = spark.createDataFrame([(f"r{i}", "s", f"u{i}") for i in range(48)], "id string, system_message string, user_message string")

    def parse(df):
        error = F.when(F.col("raw") == "u7", F.lit("odd")).cast("string")
        return df.withColumn("parse_error", error)

    store = str(tmp_path / "journal")
    answered, bad = jobs.ask_model(
        requests, lambda: lambda system, user: user, parse, max_callers=4, calls_per_second=30, store=store,
        on_failure="quarantine", attempts=2, pause_seconds=0,
    )
    assert answered.count() == 47 and rows(bad, "id") == [("r7",)]
    journal = ReplyJournal(spark, store, "string")
    sent = sorted(r["sent"] for r in journal.replies().collect())
    # any second holds no more calls than the rate, and one for each caller that was late
    assert len(sent) == 49 and all(sum(t <= x < t + 1 for x in sent) <= 30 + 4 for t in sent)
    places = rows(journal.committed().select("round", "chunk"))
    assert places == [(1, 0), (1, 1), (1, 2), (2, 0)]


def test_chunks_without_a_marker_are_asked_again(spark, tmp_path):
    store, folder = str(tmp_path / "journal"), tmp_path / "calls"
    folder.mkdir()
    requests = spark.createDataFrame([(f"r{i}", "s", f"u{i}") for i in range(4)], "id string, system_message string, user_message string")

    def model():
        def answer(system, user):
            with open(folder / user, "a") as calls_of:
                calls_of.write("x")
            return user

        return answer

    def parse(df):
        return df.withColumn("parse_error", F.lit(None).cast("string"))

    journal = ReplyJournal(spark, store, "string", run="cut-off")
    done = requests.where("id IN ('r0', 'r1')").selectExpr(
        "id", "sha2(concat_ws('\u001f', system_message, user_message), 256) AS asked", "user_message AS raw",
        "CAST(NULL AS STRING) AS call_error", "CAST(NULL AS STRING) AS parse_error", "0D AS sent",
    )
    journal.commit(done.where("id = 'r0'"), 1, 0)
    done.where("id = 'r1'").write.parquet(f"{store}/replies/run=cut-off/round=1/chunk=1")  # its marker is missing
    answered, _ = jobs.ask_model(requests, model, parse, store=store)
    assert rows(answered, "id", "raw") == [(f"r{i}", f"u{i}") for i in range(4)]
    assert sorted(p.name for p in folder.iterdir()) == ["u1", "u2", "u3"]
    jobs.ask_model(requests, model, parse, store=store)
    assert {p.read_text() for p in folder.iterdir()} == {"x"}



def test_impact_model_is_told_the_format(make_quads):
    message = jobs.impact_requests(impact_graph(make_quads), TASK).first()["user_message"]
    assert all(name in message for name in ("impact_direction", "second_order_effects", "key_uncertainties", "uncertain"))


def test_single_annotation_and_text_path(make_quads, prompts):
    quads = decision_graph(make_quads, (DATA, "e:3", v.TITLE, lit("about climate")))
    got = jobs.model_annotation(quads, TASK, "e:3", factory=keyword_model, prompts=prompts, path=v.TITLE)
    assert rows(got.annotations, "target", "body") == [("e:3", "c:2")]
    none = jobs.model_annotation(quads, TASK, "e:1", factory=keyword_model, prompts=prompts, path=v.DESCRIPTION)
    assert none.annotations.isEmpty() and none.containers.isEmpty()


def test_nodes_limit_the_batch(make_quads, prompts):
    quads = decision_graph(make_quads, (DATA, "j:1", v.JOB_SHAPE, "sh:1"), (DATA, "sh:1", v.TARGET_NODE, "e:2"))
    result = jobs.batch_model_annotation(quads, TASK, factory=keyword_model, prompts=prompts)
    assert rows(result.annotations, "target") == [("e:2",)]


def test_inputs_limit_the_batch(make_quads, prompts):
    quads = decision_graph(make_quads, *inputs_of("e:1"))
    result = jobs.batch_model_annotation(quads, TASK, factory=None, prompts=prompts)
    assert rows(result.annotations, "target") == [("e:1",)]


def failing_model():
    def answer(system, user):
        if "energy" in user[user.index("DECISION TEXT"):]:
            raise TimeoutError("late")
        return '{"designated_classes": []}'

    return answer


def test_failure_raises_or_is_kept_aside(make_quads, prompts):
    quads = decision_graph(make_quads)
    options = {"factory": failing_model, "prompts": prompts, "pause_seconds": 0}
    with pytest.raises(RuntimeError, match="after 3 attempts for e:1: TimeoutError: late"):
        jobs.batch_model_annotation(quads, TASK, **options)
    result = jobs.batch_model_annotation(quads, TASK, on_failure="quarantine", **options)
    assert rows(result.failed, "id", "call_error") == [("e:1", "TimeoutError: late")]
    assert rows(result.annotations, "target", "body") == [("e:2", v.NO_MATCH), ("e:3", v.NO_MATCH)]
    with pytest.raises(ValueError):
        jobs.batch_model_annotation(quads, TASK, on_failure="ignore", **options)


def flaky_model(folder):
    def factory():
        def answer(system, user):
            mark = folder / str(sum(map(ord, user)))
            if not mark.exists():
                mark.touch()
                return "not yet"
            return '{"designated_classes": ["Clean Energy"]}'

        return answer

    return factory


def test_only_failed_rows_are_asked_again(make_quads, prompts, tmp_path):
    result = jobs.batch_model_annotation(
        decision_graph(make_quads), TASK, factory=flaky_model(tmp_path), prompts=prompts, pause_seconds=0, attempts=2
    )
    assert rows(result.annotations, "target", "body") == [(f"e:{i}", "c:1") for i in (1, 2, 3)]


def scorer():
    def score(texts):
        if any("nothing" in t for t in texts):
            raise ValueError("no words")
        return [[2.0, -2.0] if "energy" in t else [-2.0, 0.1] for t in texts]

    return score


def test_user_supplied_classifier(make_quads):
    got = jobs.classifier_annotation_with(
        decision_graph(make_quads), TASK, scorer, ["Clean Energy", "Climate Action"], v.MULTI_LABEL, default_threshold=0.5
    )
    assert rows(got.annotations, "target", "body") == [("e:1", "c:1"), ("e:2", "c:2")]
    assert rows(got.failed) == [("e:3", "ValueError: no words")]
    with pytest.raises(ValueError):
        jobs.classifier_annotation_with(decision_graph(make_quads), TASK, scorer, ["x"], "other")


def training_graph(make_quads, n, *more):
    parts = []
    for i in range(n):
        label, word = ("c:1", "sun wind") if i % 2 else ("c:2", "rain heat")
        parts += expression(f"d:{i:03d}", f"{word} number {i % 7}") + annotation(f"a:{i}", f"d:{i:03d}", label)
    return decision_graph(make_quads, *parts, *more)


def test_training_single_label(make_quads):
    quads = training_graph(make_quads, 60, *expression("e:9", "wind sun"))
    training = jobs.train_classifier(quads, TASK, num_features=1 << 10)
    assert training.model.problem == v.SINGLE_LABEL and training.model.labels == ["Clean Energy", "Climate Action"]
    assert training.metrics.first()["accuracy"] == 1.0 and training.judged.count() == 6
    got = jobs.classifier_annotation(quads, TASK, training.model)
    assert ("e:9", "c:1") in rows(got.annotations, "target", "body")


def test_training_multi_label_and_rejects(make_quads):
    both = expression("d:both", "sun rain") + annotation("a:both", "d:both", "c:1", "c:2")
    dutch = [r for r in concept("c:3", "x") if r[2] != v.PREF_LABEL] + expression("d:nl", "x") + annotation("a:nl", "d:nl", "c:3")
    training = jobs.train_classifier(training_graph(make_quads, 60, *both, *dutch), TASK, num_features=1 << 10)
    assert training.model.problem == v.MULTI_LABEL
    assert rows(training.rejected) == [("d:nl", "c:3")]
    assert training.metrics.first()["accuracy"] > 0.8


def test_training_without_annotations(make_quads):
    assert jobs.train_classifier(decision_graph(make_quads), TASK) is None


def test_stored_classifier_scores_alike(spark, tmp_path):
    rows_ = [(f"word{i % 12} and filler", [float(k == i % 12) for k in range(13)]) for i in range(72)]
    data = spark.createDataFrame(rows_, "text string, target array<double>")
    model = clf.fit_classifier(data, [f"l{k}" for k in range(13)], v.MULTI_LABEL, num_features=1 << 10, epochs=3)
    scored = {r["text"]: r["logits"] for r in model.transform(data).collect()}
    for text, logits in scored.items():
        assert max(range(13), key=logits.__getitem__) == int(text.split()[0][4:]) and logits[12] == clf.NEVER
    model.save(str(tmp_path / "model"))
    loaded = clf.TextClassifier.load(str(tmp_path / "model"))
    assert {r["text"]: r["logits"] for r in loaded.transform(data).collect()} == scored
    plan = loaded.transform(data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def assessor():
    def answer(system, user):
        direction = "positive" if "Label: One\n\nProvide a structured impact assessment." in user else "negative"
        return json.dumps({"label": "l", "impact_direction": direction, "confidence": "high", "reasoning": "r", "direct_effects": [],
                           "second_order_effects": [], "key_uncertainties": [], "summary": "s"})

    return answer


def test_impact_job(spark, make_quads):
    quads = impact_graph(make_quads, (AI, "x:1", v.TYPE, v.ACTIVITY), (AI, "x:1", v.GENERATED, "a:1"))
    result = jobs.impact_assessment(quads, TASK, factory=assessor)
    assert rows(result.quads.select("s", "p", "o.value")) == [
        ("a:1", v.HAS_BODY, v.IMPACT_URIS["positive"]), ("x:1", v.ASSOCIATED_WITH, v.AGENTS["impact_annotator"])
    ]
    assert rows(result.containers, "resource") == [("a:1",)]
    # Once stored there is nothing left to assess.
    again = jobs.impact_assessment(quads.unionByName(result.quads), TASK, factory=assessor)
    assert again.quads.isEmpty()


def test_store_impact_needs_the_annotation(spark, make_quads):
    quads = make_quads((AI, "a:1", v.TYPE, v.ANNOTATION))
    verdicts = spark.createDataFrame(
        [("a:1", "neutral"), ("a:2", "positive"), ("a:1", "positive")], "annotation string, impact_direction string"
    )
    assert rows(wr.impact_quads(verdicts, quads).select("s", "o.value")) == [("a:1", v.IMPACT_URIS["neutral"])]


def test_only_new_keeps_one_row_per_key(spark):
    new = spark.createDataFrame([("k", 2), ("k", 1), ("m", 3)], "key string, x int")
    old = spark.createDataFrame([("m", 9)], "key string, x int")
    assert rows(wr.only_new(new, old, ["key"])) == [("k", 1)]


def test_call_model_options(spark):
    df = spark.createDataFrame([(i, "s", "u", "k") for i in range(6)], "id int, system_message string, user_message string, extra string")
    called = calls.call_model(df, lambda: (lambda s, u: s + u), keep=["extra"], max_callers=2, delay_seconds=0.001)
    assert called.rdd.getNumPartitions() == 2
    assert rows(called) == [(i, "k", "su", None) for i in range(6)]


def test_annotation_quads_round(spark, make_quads):
    found = spark.createDataFrame([("e:1", "c:1")], "target string, body string")
    quads = wr.annotation_quads(wr.annotation_rows(found, task=TASK, agent="agent:1"))
    assert rows(sel.classifying_annotations(quads, [AI]), "g") == [(AI,)]
    assert quads.count() == 8


# --- sources ---


def test_quad_table(spark, make_quads, tmp_path):
    path = str(tmp_path / "q")
    quads = make_quads(("g", "s", "p:1", lit("x", "en")), ("g", "s", "p:1", lit("x")), ("g", "s", "p:2", "o"), ("g", "s", "p:2", "o"))
    src.write_quads(quads, path)
    src.append_quads(quads, path)
    assert src.read_quads(spark, path).count() == 3
    src.append_quads(make_quads(("g", "s", "p:1", lit("x", "nl"))), path)
    assert src.read_quads(spark, path).count() == 4
    plan = src.read_quads(spark, path).where(F.col("p") == "p:1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    assert src.without_graphs(src.read_quads(spark, path), ["g"]).isEmpty()


NQUADS = [
    '<s> <p> <o> <g> .', '<s> <p> "plain" .', '<s> <p> "tagged"@en-GB <g> .', '<s> <p> "3"^^<http://x/int> <g> . # note "quoted"',
    r'<s> <p> "q\"uote \\ back \\n not newline \n newline \t tab" <g> .', r'<s> <p> "é \U0001F600 \\u00e9" <g> .',
    '_:b1 <p> _:b2 <g> .', '', '  # comment', '<s> <p> "ends with backslash \\\\" <g> .', '<s> <p> "dots . # \\" . #" <g>.',
]


def test_nquads(spark, tmp_path):
    got = src.parse_nquads(spark.createDataFrame([(x,) for x in NQUADS], "value string"), default_graph="d")
    flat = rows(got.select("g", "s", "o.value", "o.kind", "o.lang", "o.datatype"))
    assert flat == sorted([
        ("g", "s", "o", "uri", None, None), ("d", "s", "plain", "literal", None, None), ("g", "s", "tagged", "literal", "en-GB", None),
        ("g", "s", "3", "literal", None, "http://x/int"), ("g", "s", 'q"uote \\ back \\n not newline \n newline \t tab', "literal", None, None),
        ("g", "s", "é 😀 \\u00e9", "literal", None, None), ("g", "_:b1", "_:b2", "bnode", None, None),
        ("g", "s", "ends with backslash \\", "literal", None, None), ("g", "s", 'dots . # " . #', "literal", None, None),
    ], key=repr)
    src.write_nquads(got, str(tmp_path / "nq"))
    assert rows(src.read_nquads(spark, str(tmp_path / "nq"))) == rows(got)


def test_broken_nquads_line_is_an_error(spark):
    for line in ("<s> <p> <o>", "<s> <p> .", 'x <p> "o" .', '<s> <p> "open .'):
        with pytest.raises(Exception, match="not an N-Quads line"):
            src.parse_nquads(spark.createDataFrame([(line,)], "value string")).collect()


def test_broken_nquads_line_is_an_error_whatever_is_read(spark):
    lines = spark.createDataFrame([("<s> <p> <o> .",), ("garbage",)], "value string")
    for look in (lambda d: d.count(), lambda d: d.groupBy("p").count().collect(), lambda d: d.select("o").collect()):
        with pytest.raises(Exception, match="not an N-Quads line"):
            look(src.parse_nquads(lines))


def test_odd_uris_survive_nquads(spark, make_quads, tmp_path):
    odd = ["http://s/a>b", "http://s/a b", 'http://s/"<x>"', "http://s/{a|b}^`", "http://s/back\\slash", "http://s/tab\tline\nend"]
    quads = make_quads(*[(f"g:{i}", u, "p:1", u) for i, u in enumerate(odd)], ("g:1", "s:1", "p:1", lit("x", None)))
    src.write_nquads(quads, str(tmp_path / "odd"))
    assert rows(src.read_nquads(spark, str(tmp_path / "odd"))) == rows(quads)


def test_results_json(spark, tmp_path):
    document = {"head": {"vars": ["s", "t"]}, "results": {"bindings": [
        {"s": {"type": "uri", "value": "u:1"}, "t": {"type": "literal", "xml:lang": "en", "value": "x"}}, {"s": {"type": "uri", "value": "u:2"}}]}}
    (tmp_path / "r.json").write_text(json.dumps(document, indent=2))
    assert rows(results_json.read_results(spark, str(tmp_path), ["s", "t"])) == [("u:1", "x"), ("u:2", None)]


def test_prompt_settings(spark, tmp_path):
    prompts_ = {"default": {"system_message": "a", "user_message": "b"}, "s:1": {"system_message": "c", "user_message": "d"}}
    (tmp_path / "c.json").write_text(json.dumps({"other": 1, "codelist_prompts": prompts_}, indent=1))
    assert rows(settings.read_prompts(spark, str(tmp_path / "c.json"))) == [("default", "a", "b"), ("s:1", "c", "d")]


def test_report_line(spark):
    results = F.expr("array(named_struct('name','eval_f1','value',0.5D), named_struct('name','epoch','value',2.0D), named_struct('name','eval_Loss_x','value',1.23456D))")
    assert spark.range(1).select(meta.metrics_line(results)).first()[0] == "F1: 0.5000 | Loss_x: 1.2346"


# --- streams ---


def test_stream_labels_each_decision_once(spark, make_quads, prompts, tmp_path):
    schema = "decision string, text string"
    codelist = jobs.stored_codelist(decision_graph(make_quads), SCHEME)
    where = {"annotations_path": str(tmp_path / "ann"), "containers_path": str(tmp_path / "con"), "checkpoint": str(tmp_path / "cp")}
    seen = []

    def label(batch):
        seen.append(sorted(r["decision"] for r in batch.collect()))
        return jobs.label_decisions(batch, codelist, SCHEME, task=TASK, factory=None, prompts=prompts)

    def run():
        stream = inc.label_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), label, **where)
        stream.awaitTermination()

    spark.createDataFrame([("e:1", "a"), ("e:2", "b")], schema).write.parquet(str(tmp_path / "in"))
    run()
    spark.createDataFrame([("e:2", "b"), ("e:3", "c")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert seen == [["e:1", "e:2"], ["e:3"]]
    assert rows(spark.read.parquet(where["annotations_path"]), "target") == [("e:1",), ("e:2",), ("e:3",)]
    assert spark.read.parquet(where["containers_path"]).count() == 3


def test_stream_takes_up_failed_decisions(spark, make_quads, prompts, tmp_path):
    schema = "decision string, text string"
    codelist = jobs.stored_codelist(decision_graph(make_quads), SCHEME)
    root = str(tmp_path)
    down = []

    def model():
        broken, answer = bool(down), keyword_model()

        def call(system, user):
            if broken and "about climate" in user:
                raise RuntimeError("down")
            return answer(system, user)

        return call

    def label(batch):
        return jobs.label_decisions(
            batch, codelist, SCHEME, task=TASK, factory=model, prompts=prompts, attempts=1, on_failure="quarantine"
        )

    def run():
        arriving = spark.readStream.schema(schema).parquet(f"{root}/in")
        inc.label_stream(
            arriving, label, annotations_path=f"{root}/ann", containers_path=f"{root}/con", checkpoint=f"{root}/cp",
            done=inc.of_scheme(codelist),
        ).awaitTermination()

    down.append(True)
    arrived = [("e:1", "about energy"), ("e:1", "about energy"), ("e:2", "about climate")]
    spark.createDataFrame(arrived, schema).write.parquet(f"{root}/in")
    run()
    assert rows(spark.read.parquet(f"{root}/ann"), "target", "body") == [("e:1", "c:1")]
    assert rows(spark.read.parquet(f"{root}/ann-failed/batch-0"), "decision", "error") == [("e:2", "RuntimeError: down")]
    down.clear()
    spark.createDataFrame([("e:3", "about nothing")], schema).write.mode("append").parquet(f"{root}/in")
    run()
    assert rows(spark.read.parquet(f"{root}/ann"), "target") == [("e:1",), ("e:2",), ("e:3",)]


def test_failed_decisions_wait_until_they_are_due(spark, make_quads, prompts, tmp_path):
    codelist, asked = jobs.stored_codelist(decision_graph(make_quads), SCHEME), []

    def label(batch):
        asked.append(sorted(r["decision"] for r in batch.collect()))
        return jobs.label_decisions(
            batch, codelist, SCHEME, task=TASK, factory=failing_model, prompts=prompts, attempts=1, on_failure="quarantine"
        )

    def waiting(number):
        return [(r["decision"], r["tries"]) for r in spark.read.parquet(f"{tmp_path}/failed/batch-{number}").collect()]

    tables = inc.LabelledTables(*(f"{tmp_path}/{x}" for x in ("ann", "con", "failed")), retry_seconds=3600)
    assert tables.retry(spark, label) == 0
    texts = "decision string, text string"
    tables.label(spark.createDataFrame([("e:1", "about energy"), ("e:2", "on climate")], texts), label, 0, -1)
    tables.label(spark.createDataFrame([("e:3", "about nothing")], texts), label, 1, 0)
    assert asked == [["e:1", "e:2"], ["e:3"]] and waiting(1) == [("e:1", 1)]
    assert tables.retry(spark, label) == 1 and asked[-1] == []
    tables.label(spark.createDataFrame([("e:1", "about energy")], texts), label, 2, 1)
    assert asked[-1] == ["e:1"] and waiting(2) == [("e:1", 1)]
    soon = inc.LabelledTables(tables.annotations, tables.containers, tables.failed)
    spark.read.parquet(f"{tmp_path}/failed/batch-2").selectExpr("decision", "text", "error", "tries", "current_timestamp() AS due").write.parquet(
        f"{tmp_path}/failed/batch-3"
    )
    assert soon.retry(spark, label) == 1 and asked[-1] == ["e:1"] and waiting(3) == [("e:1", 2)]


def test_annotation_stream_with_and_without_state(spark, tmp_path):
    columns = "ann_uri string, task_uri string, target string, body string, motivated_by string, agent_uri string, agent_type string, g string, ts timestamp"
    arrivals = [[("t:1", "b:1"), ("t:1", "b:1"), ("t:2", "b:1")], [("t:1", "b:1"), ("t:1", "b:2")]]
    for number, pairs in enumerate(arrivals):
        data = [("a", "k", t, b, "m", "g", "y", "g", datetime.datetime(2024, 1, 1, number)) for t, b in pairs]
        spark.createDataFrame(data, columns).coalesce(1).write.parquet(f"{tmp_path}/in-{number}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for name, event_time in (("plain", None), ("timed", "ts")):
        for _ in range(2):  # a restart goes on where the stream was
            arriving = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in-*")
            inc.annotation_stream(
                arriving, annotations_path=f"{tmp_path}/{name}", checkpoint=f"{tmp_path}/{name}-cp", event_time=event_time
            ).awaitTermination()
        got = rows(spark.read.parquet(f"{tmp_path}/{name}"), "target", "body")
        assert got == [("t:1", "b:1"), ("t:1", "b:2"), ("t:2", "b:1")]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert not (tmp_path / "plain-cp" / "state").exists()
