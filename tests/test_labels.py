"""Codelists and label resolution, also against a plain-Python model."""

import random

import pytest
from small_tables import lit, rows

from conceptmill import vocab as v
from conceptmill.operators import labels as lab
from conceptmill.operators import writes as wr

SCHEMA = "scheme string, uri string, label string, definition string"


def codelist(spark, *entries):
    return spark.createDataFrame([("s", u, l, d[0] if d else None) for u, l, *d in entries], SCHEMA)


def resolve(spark, entries, labels, **kw):
    wanted = spark.createDataFrame([("s", x) for x in labels], "scheme string, label string")
    return {r["label"]: r["uri"] for r in lab.resolve_labels(wanted, codelist(spark, *entries), **kw).collect()}


def expected(entries, label):
    """What a sequential lookup over the ordered entries finds."""
    ordered = sorted(entries)
    known = {}
    for uri, text in ordered:
        for key in (text, text.lower(), text.replace(" ", "_"), text.replace(" ", "_").lower()):
            known[key] = uri
    spaced = label.replace("_", " ")
    for key in (label, spaced, label.lower(), spaced.lower()):
        if known.get(key):
            return known[key]
    start = spaced.lower().strip()
    return next((uri for uri, text in ordered if text.lower().startswith(start)), None)


def test_languages(make_quads):
    g = "g:p"
    quads = make_quads(
        *[(g, f"c:{i}", v.IN_SCHEME, "s") for i in range(5)], ("g:2", "c:0", v.IN_SCHEME, "s"),
        (g, "c:0", v.PREF_LABEL, lit("English", "en")), (g, "c:1", v.PREF_LABEL, lit("Dutch", "nl")),
        (g, "c:2", v.PREF_LABEL, lit("Untagged")), (g, "c:3", v.PREF_LABEL, lit("British", "en-GB")),
        (g, "c:4", v.PREF_LABEL, lit("Both", "en")), (g, "c:4", v.PREF_LABEL, lit("Both")),
        (g, "c:0", v.DEFINITION, lit("meaning", "en")), (g, "c:2", v.DEFINITION, lit("betekenis", "nl")),
    )
    assert rows(lab.codelist_entries(quads, "s"), "uri", "label", "definition") == [
        ("c:0", "English", "meaning"), ("c:2", "Untagged", None), ("c:4", "Both", None), ("c:4", "Both", None)
    ]


def test_empty_codelist(make_quads):
    quads = make_quads(("g", "c:1", v.IN_SCHEME, "s"))
    with pytest.raises(RuntimeError, match="s"):
        lab.codelist_of_scheme(quads, "s")
    assert lab.codelist_of_scheme(quads, "s", allow_empty=True).isEmpty()


def test_resolution_steps(spark):
    entries = [("c:1", "Clean Energy"), ("c:2", "Climate Action"), ("c:3", "clean energy plus")]
    labels = ["Clean Energy", "Clean_Energy", "CLEAN ENERGY", "clean_energy", "Clim", " climate action ", "Energy", ""]
    assert resolve(spark, entries, labels) == {
        "Clean Energy": "c:1", "Clean_Energy": "c:1", "CLEAN ENERGY": "c:1", "clean_energy": "c:1",
        "Clim": "c:2", " climate action ": "c:2", "Energy": None, "": "c:1",
    }
    assert resolve(spark, entries, ["Clim"], prefix=False) == {"Clim": None}


def test_last_entry_wins_exactly_first_wins_as_prefix(spark):
    entries = [("c:1", "Same"), ("c:2", "same"), ("c:3", "Same thing")]
    assert resolve(spark, entries, ["same", "Same", "Sam"]) == {"same": "c:2", "Same": "c:1", "Sam": "c:1"}


def test_position_column_overrides_uri_order(spark):
    placed = spark.createDataFrame([("s", "z", "Aa", None, 0), ("s", "a", "Ab", None, 1)], SCHEMA + ", ord bigint")
    wanted = spark.createDataFrame([("s", "a")], "scheme string, label string")
    assert lab.resolve_labels(wanted, placed).first()["uri"] == "z"


def test_random_labels_match_the_sequential_lookup(spark):
    rng = random.Random(7)
    words = ["a", "A", "ab", "Ab", "ab c", "AB_c", "abc", " a", "b_c", "B c d", "é", "É é", "ß", "İ"]
    entries = list({(f"c:{rng.randrange(30):02d}", " ".join(rng.choices(words, k=rng.randint(1, 3)))) for _ in range(40)})
    labels = list({"_".join(rng.choices(words + ["", "\xa0a"], k=rng.randint(1, 3))) for _ in range(150)})
    assert resolve(spark, entries, labels) == {x: expected(entries, x) for x in labels}


def test_prompt_text_is_python_text(spark):
    entries = [("c:1", "It's"), ("c:2", 'say "x"', "d\n1"), ("c:3", "Plain", ""), ("c:4", "Two", "first"), ("c:5", "Two", "last")]
    labels = [x[1] for x in entries]
    meanings = {x[1]: x[2] for x in entries if len(x) > 2 and x[2]}
    row = lab.codelist_prompt(codelist(spark, *entries)).first()
    assert row["labels"] == labels
    assert row["code_list"] == f"{labels}\n\nLabel descriptions:\n{meanings}"
    assert lab.codelist_prompt(codelist(spark, ("c:1", "One"))).first()["code_list"] == "['One']"


def test_positions_restart_per_scheme(spark):
    many = spark.createDataFrame([(f"s{i % 3}", f"c:{i:03d}", f"l{i}", None) for i in range(100)], SCHEMA)
    got = rows(lab.with_positions(many), "scheme", "ord", "uri")
    want = sorted((s, k, f"c:{i:03d}") for s in ("s0", "s1", "s2") for k, i in enumerate(j for j in range(100) if f"s{j % 3}" == s))
    assert sorted(got) == want


def test_fan_out_and_no_match(spark):
    entries = codelist(spark, ("c:1", "One"), ("c:2", "Two"))
    replies = spark.createDataFrame(
        [("s", "e:1", ["One", "two", "Three"]), ("s", "e:2", []), ("s", "e:3", ["zzz"])],
        "scheme string, decision string, classes array<string>",
    )
    fanned = lab.fan_out(replies, entries)
    assert rows(fanned, "decision", "label", "uri") == [
        ("e:1", "One", "c:1"), ("e:1", "Three", None), ("e:1", "two", "c:2"), ("e:3", "zzz", None)
    ]
    assert rows(wr.with_no_match(fanned, replies)) == [("e:1", "c:1"), ("e:1", "c:2"), ("e:2", v.NO_MATCH)]


def test_unknown_class_keeps_its_uri(spark):
    labelled = spark.createDataFrame(
        [("e:1", ["c:1", "c:9", "c:1"]), ("e:2", [])], "decision string, classes array<string>"
    )
    got = lab.classes_to_labels(labelled, codelist(spark, ("c:1", "One")))
    assert rows(got, "decision", "names") == [("e:1", ["One", "c:9", "One"]), ("e:2", [])]
