"""Steps of a model job that are done once: parsing of replies, prompts of later attempts, texts of a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from conceptmill.plans import jobs
from conceptmill.streaming import incremental as inc
from small_tables import rows


def test_replies_are_not_parsed_by_each_use_of_the_answers(spark):
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(raw):
        parsed.add(1)
        return raw

    def parse(found):
        return found.withColumn("classes", F.array(read("raw"))).withColumn("parse_error", F.lit(None).cast("string"))

    requests = spark.range(6).selectExpr("concat('r', id) AS id", "'s' AS system_message", "concat('u', id) AS user_message")
    answered, _ = jobs.ask_model(requests, lambda: lambda system, user: user, parse)
    before = parsed.value
    for _ in range(2):
        assert rows(answered.selectExpr("id", "classes[0]")) == [(f"r{k}", f"u{k}") for k in range(6)]
    assert parsed.value == before


def test_later_attempts_read_only_what_they_send(spark, monkeypatch):
    written = []

    def recorded(found, name, real=jobs.materialised):
        out = real(found, name)
        written.append((name, out.count()))
        return out

    def model():
        def call(system, user):
            if user in ("u1", "u4"):
                raise RuntimeError("down")
            return user

        return call

    monkeypatch.setattr(jobs, "materialised", recorded)
    requests = spark.range(6).selectExpr("concat('r', id) AS id", "'s' AS system_message", "concat('u', id) AS user_message")
    answered, bad = jobs.ask_model(
        requests, model, lambda found: found.withColumn("parse_error", F.lit(None).cast("string")), pause_seconds=0, on_failure="quarantine"
    )
    assert [n for name, n in written if name == "requests-again"] == [2, 2]
    assert rows(answered, "id") == [("r0",), ("r2",), ("r3",), ("r5",)] and rows(bad, "id") == [("r1",), ("r4",)]


def test_batch_writes_its_texts_once(spark, monkeypatch, tmp_path):
    written = []

    def recorded(found, name, real=inc.materialised):
        written.append((name, "text" in found.columns))
        return real(found, name)

    def label(batch):
        found = batch.selectExpr("decision AS target", "'c:1' AS body")
        annotations = jobs.wr.annotation_rows(found, task="t:1", agent="a:1")
        return jobs.JobResult(annotations, jobs.wr.output_containers(batch.selectExpr("decision AS resource"), "t:1"))

    monkeypatch.setattr(inc, "materialised", recorded)
    tables = inc.LabelledTables(*(f"{tmp_path}/{x}" for x in ("ann", "con", "failed")))
    schema = "decision string, text string"
    tables.label(spark.createDataFrame([("e:1", "b"), ("e:1", "a"), ("e:2", None), (None, "x")], schema), label, 0, -1)
    assert [name for name, texts in written if texts and name != "waiting"] == ["arrived"]
    seen = []
    tables.label(
        spark.createDataFrame([("e:2", "b"), ("e:3", "c")], schema),
        lambda batch: seen.extend(rows(batch)) or label(batch), 1, 0,
    )
    assert seen == [("e:3", "c")]
    assert rows(spark.read.parquet(f"{tmp_path}/ann").where("target IS NOT NULL"), "target") == [("e:1",), ("e:2",), ("e:3",)]
