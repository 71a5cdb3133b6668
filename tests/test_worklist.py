"""The worklist after any changes is what the store says."""

import random

import pytest
from small_tables import lit, rows
from test_selection import AI, DATA, SCHEME

from conceptmill import vocab as v
from conceptmill.operators import selection as sel
from conceptmill.operators.worklist import Worklist
from conceptmill.session import scratch_path


def store():
    """Quads of expressions and of annotations in the graph of the decisions, codelist included."""
    concepts = [(DATA, f"c:{i}", v.IN_SCHEME, SCHEME) for i in range(3)] + [(AI, "c:9", v.IN_SCHEME, SCHEME)]
    quads = list(concepts)
    for i in range(12):
        quads += [(DATA, f"e:{i}", v.TYPE, v.EXPRESSION), (DATA, f"e:{i}", v.CONTENT, lit(f"text {i}"))]
    for i in range(14):
        g, ann = (DATA, AI)[i % 2], f"a:{i}"
        quads += [
            (g, ann, v.TYPE, v.ANNOTATION), (g, ann, v.MOTIVATED_BY, v.CLASSIFYING), (g, ann, v.HAS_TARGET, f"e:{i % 12}"),
            (g, ann, v.HAS_BODY, ["c:0", "c:1", "c:9", "c:other"][i % 4]), (g, ann, v.HAS_TARGET, f"e:{i * 5 % 12}"),
        ]
    return concepts, sorted(set(quads) - set(concepts), key=repr)


@pytest.mark.parametrize("target_graph", [DATA, None])
def test_changes_in_any_order(spark, make_quads, target_graph):
    rng = random.Random(7)
    concepts, rest = store()
    work = Worklist(scratch_path(spark, "worklist"), SCHEME, target_graph, n_buckets=8)
    now = set(rng.sample(rest, len(rest) // 2))
    work.rebuild(make_quads(*concepts, *now))
    for _ in range(3):
        added = set(rng.sample([x for x in rest if x not in now], 15))
        removed = set(rng.sample(sorted(now, key=repr), 15))
        work.update(make_quads(*added), make_quads(*removed))
        now = now - removed | added
        expected = sel.unannotated_decisions(make_quads(*concepts, *now), SCHEME, target_graph=target_graph)
        assert rows(work.open_decisions(spark)) == rows(expected)
    work.update(make_quads(), make_quads(*now))
    assert work.open_decisions(spark).isEmpty()


def test_an_update_touches_its_buckets_and_never_a_changed_codelist(spark, make_quads):
    concepts, rest = store()
    work = Worklist(scratch_path(spark, "worklist"), SCHEME, DATA, n_buckets=64)
    with pytest.raises(RuntimeError, match="rebuilt"):
        work.update(make_quads(), make_quads())
    work.rebuild(make_quads(*concepts, *rest))
    files = set(work._read(spark, "marks", "ann string").inputFiles())
    work.update(make_quads(), make_quads((DATA, "a:0", v.HAS_BODY, "c:0")))
    assert len(files ^ set(work._read(spark, "marks", "ann string").inputFiles())) == 2  # one file has been replaced
    with pytest.raises(ValueError, match="codelist"):
        work.update(make_quads((DATA, "c:new", v.IN_SCHEME, SCHEME)), make_quads())
