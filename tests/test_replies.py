"""Prompts and replies against Python's own formatting and JSON rules."""

import json
import re

import pytest
from small_tables import rows
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.operators import prompts as prm
from conceptmill.operators import replies as rep

OK = '{"designated_classes": ["a", "b\\"c"]}'
REPLIES = [
    OK, f"  \n{OK}\t", f"\xa0{OK}\xa0", f"```json\n{OK}\n```", f"Sure!\n```\n{OK}\n``` bye", f"```{OK}```", f"text {OK} text",
    f"```\nnot json\n``` then {OK}", f"```json\n{OK}\n``` and ```json\n{{}}\n```", '["a"]', '{"designated_classes": []}',
    '{"designated_classes": [1, 2]}', '{"designated_classes": ["a", 1]}', '{"designated_classes": ["a", null]}',
    '{"designated_classes": [null]}', '{"designated_classes": null}', '{"designated_classes": "a"}', '{"other": ["a"]}',
    '{"designated_classes": ["a"], "why": {"x": [1, null]}}', '{"designated_classes": ["a"]', "no json at all", "", "{}", "[]",
    '{"x": 1} and {"designated_classes": ["a"]}', 'x [1] {"designated_classes": ["a"]}', '{"designated_classes": [["a"]]}',
    '{"designated_classes": [true]}', '{"designated_classes": ["é😀\\u00e9"]}', 'null', '"text"', "3",
]


def valid(text):
    try:
        found = json.loads(text)
    except ValueError:
        return None
    if not isinstance(found, dict) or not isinstance(found.get("designated_classes"), list):
        return None
    classes = found["designated_classes"]
    return classes if all(isinstance(x, str) for x in classes) else None


def expected(raw):
    text = raw.strip()
    tries = [text]
    fenced = re.search(r"```(?:json)?\s*\n?(.*?)\n?\s*```", text, re.DOTALL)
    tries += [fenced.group(1).strip()] if fenced else []
    bracketed = re.search(r"(\{.*\}|\[.*\])", text, re.DOTALL)
    tries += [bracketed.group(1)] if bracketed else []
    return next((c for c in map(valid, tries) if c is not None), None)


def test_replies(spark):
    df = spark.createDataFrame(list(enumerate(REPLIES)), "i int, raw string")
    got = {r["i"]: r for r in rep.parse_replies(df).collect()}
    for i, raw in enumerate(REPLIES):
        assert got[i]["classes"] == expected(raw), raw
        assert (got[i]["parse_error"] is None) == (expected(raw) is not None)


def test_error_shows_the_start(spark):
    df = spark.createDataFrame([("  " + "y" * 900,)], "raw string")
    assert rep.parse_replies(df).first()["parse_error"] == "no valid JSON in reply: " + "y" * 500


def test_bare_list_option(spark):
    df = spark.createDataFrame([('Answer: ["a"]',), ("[1]",), (OK,)], "raw string")
    got = [r["classes"] for r in rep.parse_replies(df, accept_bare_list=True).collect()]
    assert got == [["a"], None, ["a", 'b"c']]


ASSESSMENT = {
    "label": "x", "impact_direction": "uncertain", "confidence": "low", "reasoning": "r", "direct_effects": ["d"],
    "second_order_effects": [], "key_uncertainties": ["k", "l"], "summary": "s",
}


@pytest.mark.parametrize(
    "change, ok",
    [({}, True), ({"impact_direction": "mixed"}, False), ({"confidence": "sure"}, False), ({"label": 3}, False), ({"label": None}, False),
     ({"direct_effects": ["a", 1]}, False), ({"direct_effects": "a"}, False), ({"extra": 1}, True), ({"summary": ...}, False)],
)
def test_impact(spark, change, ok):
    data = {k: x for k, x in {**ASSESSMENT, **change}.items() if x is not ...}
    row = rep.parse_impact(spark.createDataFrame([(json.dumps(data),)], "raw string")).first()
    assert (row["assessment"] is not None) == ok
    assert row["impact_uri"] == (v.IMPACT_URIS["uncertain"] if ok else None)
    if ok:
        assert row["assessment"].asDict() == ASSESSMENT


TEMPLATES = ["{code_list} and {decision_text}", "{decision_text}{decision_text}{code_list}", "no placeholder", "{{x}} {code_list}", "{{{decision_text}}}", ""]


def test_rendering_is_pythons_format(spark):
    texts = ["plain", "{code_list} {decision_text} {{", "a$1\\b\n"]
    data = [(t, x) for t in TEMPLATES for x in texts]
    df = spark.createDataFrame(data, "t string, x string")
    got = rows(df.select("t", "x", prm.render(F.col("t"), F.lit("['{decision_text}']"), F.col("x")).alias("r")))
    assert got == sorted([(t, x, t.format(code_list="['{decision_text}']", decision_text=x)) for t, x in data], key=repr)


@pytest.mark.parametrize("template", ["{other}", "open {", "close }", "{code_list"])
def test_unknown_placeholder_is_an_error(spark, template):
    df = spark.createDataFrame([(template,)], "t string")
    with pytest.raises(Exception, match="unknown placeholder"):
        df.select(prm.render(F.col("t"), F.lit("c"), F.lit("d"))).collect()


def test_reply_format_follows_the_prompt(spark):
    got = spark.range(1).select(prm.label_prompt(F.lit("{decision_text}"), F.lit("c"), F.lit("d"))).first()[0]
    assert got.startswith("d\n\nIMPORTANT: You must respond ONLY with valid JSON matching this schema:\n{\n  \"properties\"")
    assert json.loads(got[got.index("{"): got.rindex("}") + 1])["required"] == ["designated_classes"]


def test_prompt_choice(spark):
    schema = "scheme string, system_message string, user_message string"
    schemes = spark.createDataFrame([("s:1",), ("s:2",)], "scheme string")
    own = spark.createDataFrame([("s:1", "sys", "usr"), ("default", "dsys", "dusr")], schema)
    assert rows(prm.prompts_for_schemes(schemes, own)) == [("s:1", "sys", "usr"), ("s:2", "dsys", "dusr")]
    none = spark.createDataFrame([], schema)
    assert rows(prm.prompts_for_schemes(schemes, none))[0] == ("s:1", v.DEFAULT_SYSTEM_MESSAGE, v.DEFAULT_USER_MESSAGE)
