"""What the driver holds: how many tables and how large plans the iterating operators make."""

import random

import numpy as np

from conceptmill.llm import components, mixing, ngram_join


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def recorded(monkeypatch, module, made):
    monkeypatch.setattr(module, "written", lambda df, name, real=module.written: made.append((name, plan(df))) or real(df, name))


def test_stars_are_seen_without_a_round(spark, monkeypatch):
    made = []
    recorded(monkeypatch, components, made)
    got = components.components(spark.createDataFrame([(1, 2), (3, 1), (9, 7), (7, 7), (2, 1)], "a bigint, b bigint"))
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (3, 1), (7, 7), (9, 7)]
    assert len(made) == 1
    chain = [(i, i + 1) for i in range(1, 12)]
    random.Random(1).shuffle(chain)
    got = components.components(spark.createDataFrame(chain, "a bigint, b bigint"))
    assert sorted(map(tuple, got.collect())) == [(i, 1) for i in range(1, 13)]
    assert all(text.count("Join ") <= 1 for _, text in made)


def test_later_parts_come_from_parts_and_new_links(spark, monkeypatch):
    """All texts share their words, so the large buckets are looked at; what was linked before is not linked anew."""
    monkeypatch.setattr(ngram_join, "SMALL_BUCKET", 1)
    made, given = [], []
    recorded(monkeypatch, ngram_join, made)
    monkeypatch.setattr(ngram_join, "stars", lambda links, real=ngram_join.stars: given.append(links.count()) or real(links))
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"own{i}"])) for i in range(8)] + [(20 + i, " ".join([*base[::-1], f"own{i}"])) for i in range(8)]
    rows += [(40, "quite another text of some words")]
    got = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: 0 if i < 8 else 20 if i < 40 else 40 for i, _ in rows}
    assert given[0] == 0 and len(given) == 2
    looked = [text for name, text in made if name == "open-buckets"]
    assert looked and all(text.count("Union") == 0 for text in looked)


def test_classes_are_made_block_by_block(spark, monkeypatch):
    """The classes are those of the whole table of counts, which nothing holds as numbers of eight bytes."""
    sizes = []
    monkeypatch.setattr(ngram_join.np, "zeros", lambda shape, *a, real=np.zeros: sizes.append(real(shape, *a).nbytes) or real(shape, *a))
    texts = [" ".join(f"w{random.Random(i).randrange(40)}" for i in range(n, n + 50)) for n in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    scanned = ngram_join.written(ngram_join.scan(docs, 1), "shingles")
    classes, frequent = ngram_join.frequency_classes(scanned)
    assert max(sizes) == 1 << ngram_join.SKETCH_BITS
    table = np.zeros(1 << ngram_join.SKETCH_BITS)
    for text in texts:
        grams = ngram_join.shingle_set(text.encode(), ngram_join.WordHashes(), 1)
        table[(grams & np.uint64(table.size - 1)).astype(np.int64)] += 1
    assert classes.dtype == np.uint8
    assert (classes == np.minimum(255, np.round(8 * np.log2(table + 1)))).all()
    limit = table.sum() / table.size + ngram_join.FREQUENT_ABOVE
    assert frequent == np.ceil(8 * np.log2(limit + 1))


def test_targets_are_worked_out_once(spark):
    docs = spark.createDataFrame([(i, "a b c " * 30, "s" + str(i % 3)) for i in range(9)], "doc_id bigint, text string, source string")
    for mixed in (mixing.mixed_texts(docs), mixing.mix_documents(docs)):
        assert "wanted" not in plan(mixed)
        assert mixed.count() >= 9
