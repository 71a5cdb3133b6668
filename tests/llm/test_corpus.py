"""Operators on the corpus as a whole: 2, 5, 6, 8, 9, components and the pipeline."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conceptmill.llm import components, decontamination, mixing, ngram_join, pii, queries, sharding


def low(text):
    return (text or "").encode().lower().split()


# --- 2: personal data ------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def count_digits(text):
    return len(re.sub("[^0-9]", "", text))


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= count_digits(m) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= count_digits(m) <= 15),
]


def base_spans(text):
    spans = []
    for k, (kind, pattern, valid) in enumerate(BASE):
        spans += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if valid(m.group())]
    return sorted(spans)


ODD = [
    "a@b.c_d@e.f and x.y@z @q.r s@t..u one@two.three-four.5.",
    "1.2.3.4.5.6.7.8 1.2..3.4.5.6 0001.02.255.0256 256.1.1.1 0.0.0.000",
    "4111 1111 1111 1111 4111-1111-1111-1111x 41111111  11111111 4 1 1 1-1111 1111 1111 1 378282246310005",
    "+1 (988) 555-2485, +12, ++49 30 123456-, +1 2 3 4 5 6 7 8 9 ) +123456789012345678",
    "é\U0001f600 mail me: é.a@b.de \U0001f600 +49 170 1234567 \U0001f600",
    "1" * 30 + " " + "2-" * 40 + "3",
    "a" * 5000 + "@",
    ("1 " * 4000).strip(),
    "+" * 3000 + "1" + " " * 3000,
]


def test_base_spans_match_brute_force(spark, documents, edge_docs, no_docs):
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    docs = documents.select("doc_id", "text").unionByName(odd)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = pii.find_personal_data(docs).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = base_spans(text[r["doc_id"]])
        assert [(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["in_base"]] == [(a, k, b) for a, _, b, k in want]
    assert sum(len(r["spans"]) for r in rows) > 0
    edges = pii.find_personal_data(edge_docs).collect()
    assert len(edges) == 12 and all(r["spans"] == [] for r in edges)
    assert pii.find_personal_data(no_docs).collect() == []


def test_added_spans_and_redaction(spark):
    rows = []
    for i in range(60):
        rows.append((3 * i, f"write an email to user{i}@mail.example.com or call phone +1 (988) 555-{1000 + i} soon"))
        rows.append((3 * i + 1, f"the password=k{i * 7919**4:020d} is old, server ip address 10.0.{i}.7 too"))
        rows.append((3 * i + 2, f"build 12.13.14.999 took {i} of 4111 1111 1111 1112 steps"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = pii.find_personal_data(docs)
    kinds = Counter(s["kind"] for r in found.collect() for s in r["spans"])
    assert kinds["secret"] == 60 and kinds["email"] == 60 and kinds["phone"] == 60 and kinds["ip"] == 60 and "card" not in kinds
    text = {r["doc_id"]: r["text"] for r in pii.redacted(docs, found).collect()}
    assert text[0] == "write an email to [email] or call phone [phone] soon"
    assert text[1] == "the password=[secret] is old, server ip address [ip] too"
    assert text[2] == rows[2][1]


def test_secrets_of_any_length(spark):
    long_one = "a1" * 3000
    docs = spark.createDataFrame([(i, f"the api_key={long_one}{i:04d} is old") for i in range(40)], "doc_id bigint, text string")
    found = pii.find_personal_data(docs)
    text = {r["doc_id"]: r["text"] for r in pii.redacted(docs, found).collect()}
    assert text[3] == "the api_key=[secret] is old"


# --- components and 5: near copies ---------------------------------------------------


def united(nodes, links):
    above = {n: n for n in nodes}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + chain + [(2000, i) for i in range(2001, 2030)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r["node"]: r["component"] for r in got.collect()} == united(nodes, [x for x in links if x[0] != x[1]])
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def brute_components(rows, n=3, percent=90):
    sets = {}
    for doc_id, text in rows:
        words = low(text)
        sets[doc_id] = frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()
    holders, links = defaultdict(list), []
    for doc_id, grams in sets.items():
        shared = Counter(other for g in grams for other in holders[g])
        for other, same in shared.items():
            if 100 * same >= percent * (len(grams) + len(sets[other]) - same):
                links.append((doc_id, other))
        for g in grams:
            holders[g].append(doc_id)
    return {i: len(s) for i, s in sets.items()}, united(sets, links)


def near_copies(seed=3):
    """Groups around texts of several sizes: one word changed in each copy, and some a little further off."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 100
    rows = []
    for size in (4, 9, 12, 25, 70, 140, 290, 320):
        origin = [rng.choice(words) for _ in range(size)]
        for copy in range(9):
            text = list(origin)
            for _ in range(copy % 4 * max(1, size // 70)):
                text[rng.randrange(size)] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("bucket,frequent,paired", [(32, (8, 64), 300), (1, (8, 64), 300), (2, (0, 0), 300), (32, (0, 1), 50)])
def test_links_match_brute_force(spark, monkeypatch, bucket, frequent, paired):
    monkeypatch.setattr(ngram_join, "SMALL_BUCKET", bucket)
    monkeypatch.setattr(ngram_join, "FREQUENT_TIMES", frequent[0])
    monkeypatch.setattr(ngram_join, "FREQUENT_ABOVE", frequent[1])
    monkeypatch.setattr(ngram_join, "PAIRED_SIZE", paired)
    rows = near_copies()
    sizes, expected = brute_components(rows)
    got = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert len(set(expected.values())) < len(rows) - 20


def test_links_on_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    sizes, expected = brute_components(rows)
    got = ngram_join.link_documents(documents).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (sizes[i], expected[i]) for i in expected}


def test_join_edges(edge_docs, no_docs):
    rows = ngram_join.link_documents(edge_docs).collect()
    assert len(rows) == 12
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got[1][1] == got[2][1] == got[3][1] == 1
    assert got[4] == (0, 4) and got[5] == (0, 5) and got[6] == (0, 6) and got[None][1] is None and got[9][1] == 9
    first = ngram_join.first_of_each(edge_docs)
    assert first.columns == edge_docs.columns
    assert sorted((r["doc_id"] or 0) for r in first.collect()) == [0, 1, 4, 5, 6, 7, 8, 9, 12]
    assert ngram_join.link_documents(no_docs).collect() == []


def test_rows_are_kept_by_row_not_by_id(spark):
    one, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, one, 0), (2, other, 1), (2, one, 2), (None, one, 3), (None, other + " c", 4), (None, "alone here", 5), (1, one, 6), (7, "", 7), (7, "", 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _copy int").withColumn("id", F.lit("x"))
    got = ngram_join.first_of_each(docs)
    assert got.columns == docs.columns
    kept = sorted(r["_copy"] for r in got.collect())
    assert kept[0] in (0, 6) and kept[1:] == [1, 5, 7, 8] or kept == [1, 5, 6, 7, 8]
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "_copy", F.lit(1).alias("digest"))
    assert ngram_join.first_of_each(named).count() == len(kept)


def test_leaks_are_dropped_by_text_not_by_id(spark):
    passage = " ".join(f"word{i}" for i in range(30))
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    rows = [(None, "clean " + passage, 0), (None, "a clean text", 1), (3, passage, 2), (3, "another clean text", 3), (4, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _leak int").withColumn("digest", F.lit("d"))
    got = decontamination.clean_documents(docs, bench)
    assert got.columns == docs.columns and sorted(r["_leak"] for r in got.collect()) == [1, 3, 4]


# --- 6: sharding -------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 97, 1000, 4099])
def test_permutation(n):
    for seed in (1, 42):
        assert sorted(sharding.permuted(np.arange(n), n, seed)) == list(range(n))
    if n > 90:
        assert (sharding.permuted(np.arange(n), n, 1) != sharding.permuted(np.arange(n), n, 2)).any()


def test_shards_of_columns_with_inner_names(spark):
    names = ["_uid", "_digest", "_range", "_inside", "_start", "_number", "_place", "number", "place", "doc", "uid"]
    docs = spark.createDataFrame([(i, "t", *range(i, i + len(names))) for i in range(20)], ["doc_id", "text", *names])
    got = sharding.shard_documents(docs, 4)
    assert got.columns == [*docs.columns, "size", "text_crc32", "shard", "slot"]
    assert all(r[n] == r["doc_id"] + i for r in got.collect() for i, n in enumerate(names))


def test_shards(documents, edge_docs, no_docs, tmp_path):
    once = {tuple(r) for r in sharding.shard_documents(documents, 7).select("doc_id", "shard", "slot").collect()}
    again = {tuple(r) for r in sharding.shard_documents(documents.repartition(5), 7).select("doc_id", "shard", "slot").collect()}
    assert once == again
    for docs in (documents, edge_docs):
        rows = sharding.shard_documents(docs, 7).collect()
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
            data = (r["text"] or "").encode()
            assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert max(map(len, slots.values())) - min(len(slots[i]) for i in range(7)) <= 1
    assert sharding.shard_documents(no_docs).collect() == []
    sharding.write_shards(sharding.shard_documents(documents, 3), str(tmp_path / "s"))
    assert documents.sparkSession.read.parquet(str(tmp_path / "s")).count() == documents.count()


# --- 8: mixing ----------------------------------------------------------------------


def brute_targets(sizes):
    """Shares by weight; what a full source cannot take is shared out again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        for s in free:
            target[s] = rest * weight[s] / sum(weight[x] for x in free)
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        for s in over:
            target[s] = 2.0 * sizes[s]
        full |= over


def test_mix_comes_near_its_targets(documents):
    rows = mixing.mix_documents(documents).collect()
    assert len(rows) == documents.count()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    target = brute_targets(sizes)
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
    assert all(abs(taken[s] - target[s]) <= 0.12 * target[s] for s in sizes)
    again = mixing.mix_documents(documents.repartition(3)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_a_source_is_permuted(spark):
    draws = spark.createDataFrame([(0, s, 50, 7) for s in range(16)] + [(1, 0, 3, 6)], "rank bigint, shard int, n_blocks bigint, n_slots bigint")
    rows = mixing.taken_blocks(draws).collect()
    for rank, epoch, n in ((0, 0, 50), (0, 1, 50), (1, 0, 3), (1, 1, 3)):
        assert sorted(r["block"] for r in rows if (r["rank"], r["epoch"]) == (rank, epoch)) == list(range(n))
    first = [r["block"] for r in sorted(rows, key=lambda r: r["shard"]) if (r["rank"], r["epoch"]) == (0, 0)]
    assert first != sorted(first) and len(rows) == 106


def test_mixed_texts_hold_the_words_taken(documents, edge_docs, no_docs):
    for docs in (documents, edge_docs):
        want = Counter()
        for r in mixing.mix_documents(docs).collect():
            want[r["doc_id"]] += r["taken"]
        mixed = mixing.mixed_texts(docs)
        assert mixed.columns == docs.columns
        got, own = Counter(), defaultdict(Counter)
        for r in docs.collect():
            own[r["doc_id"]].update((r["text"] or "").split())
        for r in mixed.collect():
            got[r["doc_id"]] += len(r["text"].split())
            assert r["n_chars"] == len(r["text"]) and not Counter(r["text"].split()) - own[r["doc_id"]]
        assert +want == got
    rows = {r["doc_id"]: r for r in mixing.mix_documents(edge_docs).collect()}
    assert rows[4]["taken"] == 0 and rows[4]["size"] == 0 and rows[6]["target"] == 0
    assert mixing.mix_documents(no_docs).collect() == [] and mixing.mixed_texts(no_docs).collect() == []


# --- 9: decontamination ---------------------------------------------------------------


def test_leaks_of_exact_and_changed_passages(spark):
    rng = random.Random(5)
    words = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(20 + i))) for i in range(10)] + [(99, "too short"), (None, None)]
    docs, expected = [], set()
    for i in range(200):
        text = [rng.choice(words) for _ in range(120)]
        if i % 4 == 0:
            item = items[i % 10][1].split()
            for at in range(5, len(item), 9):  # one word in nine differs
                item[at] = "changed" if i % 8 == 0 else item[at]
            text[40:40] = [w.upper() + "," for w in item]
            expected.add((i, i % 10))
        docs.append((i, " ".join(text)))
    got = decontamination.find_leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected
    assert all(r["doc_start"] - r["item_start"] == 40 and r["n_same"] >= 0.8 * r["n_overlap"] for r in got)


def test_leaks_match_brute_force(spark, sf, documents):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(documents, benchmark).collect()}
    plain = decontamination.plain_words
    items = [(r["item_id"], plain(r["text"].encode())) for r in benchmark.collect()]
    by_run = defaultdict(set)
    for item_id, words in items:
        for i in range(len(words) - 9):
            by_run[tuple(words[i : i + 10])].add(item_id)
    whole = set()
    for r in documents.collect():
        words = plain(r["text"].encode())
        for i in range(len(words) - 9):
            whole |= {(r["doc_id"], item) for item in by_run.get(tuple(words[i : i + 10]), ())}
    assert found >= whole and len(found - whole) <= 1
    clean = decontamination.clean_documents(documents, benchmark)
    assert clean.columns == documents.columns
    assert {r["doc_id"] for r in documents.collect()} - {r["doc_id"] for r in clean.collect()} == {d for d, _ in found}


def test_leak_edges(spark, edge_docs, no_docs):
    benchmark = edge_docs.select(F.col("doc_id").alias("item_id"), "text").where("item_id in (1, 5) or item_id is null or text is null")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(edge_docs, benchmark).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (None, None)}
    assert decontamination.find_leaks(no_docs, benchmark).collect() == []
    assert decontamination.find_leaks(edge_docs, benchmark.limit(0)).collect() == []


def brute_overlap(doc, item, shift):
    """Every stretch on the diagonal; the longest that is a leak, the first of equals."""
    start, stop, best = max(0, -shift), min(len(item), len(doc) - shift), (0, 0, 0, 0)
    for i in range(start, stop):
        for j in range(i + 10, stop + 1):
            same = sum(item[k] == doc[k + shift] for k in range(i, j))
            if 5 * same >= 4 * (j - i) and j - i > best[2]:
                best = (i + shift, i, j - i, same)
    return best


def test_longest_overlap_matches_brute_force():
    rng = random.Random(11)
    found = 0
    for _ in range(1500):
        item = [f"i{k}" for k in range(rng.choice((9, 10, 11, 15, 18, 30, 45)))]
        doc = [w if rng.random() < rng.choice((0.7, 0.8, 0.9)) else "x" for w in item]
        at = rng.randrange(len(doc))
        doc[at : at + rng.randrange(4)] = ["x"] * len(doc[at : at + 3])
        doc = doc[rng.randrange(4) :]
        shift = next((k - int(w[1:]) for k, w in enumerate(doc) if w != "x"), 0)
        got = decontamination.longest_overlap(doc, item, shift)
        assert got == brute_overlap(doc, item, shift)
        found += got[2] > 0
    assert 300 < found < 1400


def test_neighbouring_substitutions_are_leaks(spark):
    """9 equal words, 2 different, 4 equal: 13 of 15."""
    item = [f"i{k}" for k in range(15)]
    docs = [(0, " ".join(item[:9] + ["x", "y"] + item[11:]))]
    got = decontamination.find_leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string"),
    ).collect()
    assert sorted(tuple(r) for r in got) == [(0, 7, 0, 0, 15, 13, 15)]


def avoids(bits, different):
    """Whether a mask has a place in a stretch at which it leaves out all that differs."""
    n = len(different)
    return any(all(b == "0" or not different[i + k] for k, b in enumerate(bits)) for i in range(n - len(bits) + 1))


def test_every_leak_has_a_seed():
    for n in range(10, 20):
        for k in range(n // 5 + 1):
            for places in itertools.combinations(range(n), k):
                different = [i in places for i in range(n)]
                assert any(avoids(mask, different) for mask in decontamination.MASKS)


def test_changed_and_short_items_match_brute_force(spark):
    rng = random.Random(21)
    words = [f"v{i}" for i in range(2000)]
    items = [[rng.choice(words) for _ in range(n)] for n in (1, 2, 5, 9, 10, 11, 14, 15, 18, 30, 59)]
    docs = [["only"], items[0], items[3], items[4]]
    for i in range(330):
        item = items[i % 11]
        n = len(item) if i % 3 else min(len(item), 10 + i % 9)  # whole, or a part of it
        at = rng.randrange(len(item) - n + 1)
        part = list(item[at : at + n])
        first = rng.randrange(n)
        for k in range(rng.randrange(n // 4 + 2)):  # neighbours or anywhere
            part[(first + k) % n if i % 2 else rng.randrange(n)] = "changed"
        text = [rng.choice(words) for _ in range(rng.choice((0, 1, 40)))]
        docs.append(text + part + [rng.choice(words) for _ in range(rng.choice((0, 1, 40)))])
    expected = {}
    for d, doc in enumerate(docs):
        for t, item in enumerate(items):
            if len(item) < 10:
                n = len(item)
                at = [i for i in range(len(doc) - n + 1) if doc[i : i + n] == item]
                best = (at[0], 0, n, n) if at else (0, 0, 0, 0)
            else:
                found = (brute_overlap(doc, item, shift) for shift in range(1 - len(item), len(doc)) if sum(a == b for a, b in zip(doc[max(0, shift) :], item[max(0, -shift) :])) > 7)
                best = max(found, key=lambda x: (x[2], x[3], -x[0], -x[1]), default=(0, 0, 0, 0))
            if best[2]:
                expected[d, t] = (*best, len(item))
    got = decontamination.find_leaks(
        spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id bigint, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string"),
    ).collect()
    assert {(r[0], r[1]): tuple(r[2:]) for r in got} == expected and len(got) == len(expected)
    assert {t for _, t in expected} == set(range(11)) and len(expected) > 150


# --- pipeline and queries ----------------------------------------------------------------


def test_pipeline_stage_by_stage(spark, sf, documents):
    labels, benchmark = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    docs, ids = documents, []
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, sf)
        assert kept.columns == documents.columns
        ids.append({r["doc_id"] for r in kept.collect()})
        docs = docs.where(F.col("doc_id").isin(list(ids[-1])))
    from conceptmill.llm import quality_rules

    assert ids[0] == {r["doc_id"] for r in quality_rules.score_quality(documents, labels).where("kept").collect()}
    rows = [(r["doc_id"], r["text"]) for r in documents.collect() if r["doc_id"] in ids[0]]
    _, groups = brute_components(rows, corpus_pipeline.NEAR_COPY_WORDS, corpus_pipeline.NEAR_COPY_PERCENT)
    assert ids[1] == {i for i, first in groups.items() if i == first}
    second = documents.where(F.col("doc_id").isin(list(ids[1])))
    assert ids[1] - ids[2] == {r["doc_id"] for r in decontamination.find_leaks(second, benchmark).collect()}
    final = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "text", "shard", "slot"} <= set(final.columns)
    words = Counter()
    for r in mixing.mix_documents(docs).collect():
        words[r["doc_id"]] += r["taken"]
    got = Counter()
    for r in final.collect():
        got[r["doc_id"]] += len(r["text"].split())
    assert got == +words


def test_near_copy_stage_takes_five_words_and_80_percent(spark, sf, documents):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    near = near_copies()
    for size in (40, 80, 160, 310):  # copies between the rule of the stage and that of operator 5
        origin = [rng.choice(words) for _ in range(size)]
        for copy in range(4):
            text = list(origin)
            for at in range(copy * 3, size, 50):
                text[at] = f"c{copy}"
            near.append((len(near), " ".join(text)))
    for docs in (spark.createDataFrame(near, "doc_id bigint, text string"), documents):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        firsts = [{i for i, first in brute_components(rows, *rule)[1].items() if i == first} for rule in ((5, 80), (3, 90))]
        got = [r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, sf).collect()]
        assert sorted(got) == sorted(firsts[0]) and firsts[0] != firsts[1]


def test_pipeline_on_an_empty_table(spark, sf, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.collect() == []


def test_query_columns(spark, sf):
    want = {
        "op1_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        "op2_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        "op3_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept"],
        "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op5_ngram_join": ["doc_id", "n_shingles", "component_id"],
        "op6_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op8_mixing": ["doc_id", "size", "source_size", "target", "taken"],
        "op10_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    }
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, sf).columns == columns
    row = queries.QUERIES["op2_pii"](spark, sf).where("n_email > 0").first()
    text = spark.read.parquet(f"{sf}/documents.parquet").where(f"doc_id = {row['doc_id']}").first()["text"]
    joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base_spans(text))
    assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
