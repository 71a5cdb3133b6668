"""Work that has to stay small in each task when tables grow."""

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from conceptmill.operators import classifier as clf
from conceptmill.operators import model_calls as calls
from conceptmill.plans import bridge as br
from conceptmill.plans import jobs
from conceptmill.sources import keyed
from conceptmill.sources.journal import ReplyJournal


def test_quads_of_a_small_file_are_made_by_many_tasks(spark, monkeypatch):
    parts = spark.range(2000).selectExpr("id AS p_partkey", "'B' AS p_brand", "5 AS p_size").coalesce(1)
    rules = [br.Rule("part", br.PUBLIC, br.PART, "p", br.BRAND)] * 2
    assert br._dealt(parts, rules) is parts
    monkeypatch.setattr(br, "TASK_QUADS", 1000)
    dealt = br._dealt(parts, rules)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert dealt.columns == ["p_partkey", "p_brand"] and sum(sizes) == 2000 and max(sizes) < 1000


def test_a_round_has_a_bounded_number_of_chunks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(jobs, "CHUNK_ROWS", 1)
    monkeypatch.setattr(jobs, "MOST_CHUNKS", 3)
    requests = spark.createDataFrame([(f"r{i}", "s", f"u{i}") for i in range(20)], "id string, system_message string, user_message string")
    store = str(tmp_path / "journal")
    answered, bad = jobs.ask_model(
        requests, lambda: lambda system, user: user, lambda df: df.withColumn("parse_error", F.lit(None).cast("string")),
        max_callers=2, store=store,
    )
    assert sorted(r["raw"] for r in answered.collect()) == sorted(f"u{i}" for i in range(20)) and bad.isEmpty()
    assert ReplyJournal(spark, store, "string").committed().count() == 3


def test_a_caller_holds_few_prompts_at_a_time(spark):
    def factory():
        return lambda system, user: str(len(sys._getframe(1).f_locals["batch"]))

    prompts = spark.range(600).selectExpr("id", "'s' AS system_message", "concat('u', id) AS user_message").coalesce(1)
    got = calls.call_model(prompts, factory, timed=True).collect()
    assert sorted(r["id"] for r in got) == list(range(600)) and all(r["sent"] > 0 for r in got)
    assert max(int(r["raw"]) for r in got) <= calls.SLICE


def test_new_rows_are_compared_by_many_tasks(spark, monkeypatch, tmp_path):
    seen = []

    def only_new(new, *rest):
        seen.append(new.rdd.getNumPartitions())
        return keep(new, *rest)

    keep = keyed.only_new
    monkeypatch.setattr(keyed, "only_new", only_new)
    monkeypatch.setattr(keyed, "TASK_ROWS", 100, raising=False)
    table = keyed.KeyedTable(str(tmp_path / "t"), "k string, v string", ["k"], ["k"])
    rows = spark.range(1000).selectExpr("concat('k', id % 400) AS k", "concat('v', id % 2) AS v")
    table.append(rows)
    table.append(rows)
    assert seen == [10, 10]
    stored = spark.read.parquet(table.path)
    assert stored.count() == 400 and stored.select("k").distinct().count() == 400


def test_a_step_takes_lists_flat():
    lists = [[1, 7, 3], [], [9], [3, 50]], [[0.5, 1.0, 2.0], [], [4.0], [1.0, 1.0]], [[0], [1, 2], [], [5]]
    kinds = pa.int32(), pa.float64(), pa.int32()
    whole = pa.RecordBatch.from_arrays([pa.array(x, pa.list_(k)) for x, k in zip(lists, kinds, strict=True)], names=list("abc"))
    for batch, texts in ((whole, [0, 1, 2, 3]), (whole.slice(2), [2, 3])):
        ((place, value, starts, owner, truth),) = clf._batches([batch], np.array([3, 7, 9]), 2, 1)
        places, values = {0: [1, 0], 1: [], 2: [2], 3: [0]}, {0: [1.0, 2.0], 1: [], 2: [4.0], 3: [1.0]}
        assert place.tolist() == [x for t in texts for x in places[t]] and value.tolist() == [x for t in texts for x in values[t]]
        assert owner.tolist() == [i for i, t in enumerate(texts) for _ in places[t]]
        assert starts.tolist() == np.cumsum([0, *(len(places[t]) for t in texts)])[:-1].tolist()
        assert truth.tolist() == [[[0, 0], [1, 1], [0, 0], [0, 0]][t] for t in texts]


def test_a_mean_goes_on_in_the_next_batch():
    def batch(*rows):
        at, n, change = zip(*rows, strict=True)
        return pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "n": pa.array(n, pa.int64()), "change": pa.array([np.array(c, "<f8").tobytes() for c in change])})

    rows = [(1, 1, [1.0, 0.0]), (4, 1, [2.0, 2.0]), (4, 3, [6.0, 2.0]), (9, 2, [1.0, 5.0])]
    for cut in (1, 2, 3, 4):
        made = clf._averaged(b for b in (batch(*rows[:cut]), *([batch(*rows[cut:])] if rows[cut:] else [])))
        means = {a: np.frombuffer(c, "<f8").tolist() for m in made for a, c in zip(m.column("at").to_pylist(), m.column("change").to_pylist(), strict=True)}
        assert means == {1: [1.0, 0.0], 4: [5.0, 2.0], 9: [1.0, 5.0]}
