"""Operators 11, 12 and 13: repair of conversations, license scans, importance resampling."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptmill.llm import conversations, licenses, resampling

TURNS = "conv_id bigint, turn bigint, role string, text string, digest string, cost int, place string"


# --- 11: conversations -------------------------------------------------------------


def faults(rows):
    """Sorted rows with their first fault."""
    ordered, seen, found = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])), set(), []
    for turn, role, text in ordered:
        spoken = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "blank" if not spoken else "duplicate" if (role, text) in seen else "" if spoken[-1] in ".!?" else "truncated"
        seen.add((role, text))
        found.append((turn, role, text, fault))
    return found


def cheapest(found):
    """(cost, audit, repaired lines) by a search over all edits, cheapest and then least text first."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, initials, lines = heapq.heappop(heap)
        if (at, initials) in done or len(initials) > 2 * len(found) + 4:
            continue
        done.add((at, initials))
        if at == len(found) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, lines
        if not re.fullmatch("s?(ua)*u?", initials):
            continue
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, audit + "I", at, initials + role[0], (*lines, f"{role}:")))
        if at < len(found):
            _, role, text, fault = found[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, initials, lines))
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                if role:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, initials + role[0], (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + more + 3, audit + "R", at + 1, initials + new[0], (*lines, f"{new}:{text}")))
    raise AssertionError


def expected_report(rows):
    found = faults(rows)
    cost, audit, lines = cheapest(found)
    numbers = [t for t, *_ in found if t is not None]
    pairs = [(a[1][:1], b[1][:1]) for a, b in zip(found, found[1:], strict=False)]
    kinds = Counter(f for *_, f in found)
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        "blank": kinds["blank"], "duplicate": kinds["duplicate"], "truncated": kinds["truncated"],
        "illegal": sum("".join(p) not in ("su", "ua", "au") for p in pairs),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def random_conversations(seed, n, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "assistant", "user", "system", "tool", "u", ""]
    texts = ["Yes.", "No", "Why?", " ", "", "Well\n", "Good!\t", "a b", "c."]
    rows = []
    for conv_id in range(n):
        for turn in range(rng.randrange(1, longest)):
            number = None if rng.random() < 0.1 else turn + rng.randrange(2)
            rows.append((conv_id if conv_id else None, number, rng.choice(roles), rng.choice(texts)))
            if rng.random() < 0.1:
                rows += [rows[-1]] * rng.randrange(1, 4)
    return rows


@pytest.mark.parametrize("piece", [1, 3, 1 << 16])
def test_repairs_match_a_search_over_all_edits(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE_TURNS", piece)
    rows = random_conversations(piece, 60, 7)
    table = spark.createDataFrame([(*r, "d", 1, "p") for r in rows], TURNS)
    got = {r["conv_id"]: r for r in conversations.repair_conversations(table).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv_id, row in got.items():
        expected = expected_report([r[1:] for r in rows if r[0] == conv_id])
        assert {k: row[k] for k in expected} == expected


def test_one_long_conversation_over_many_pieces(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"text {i % 90}" + rng.choice([".", ""])) for i in range(3000)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    whole = conversations.repair_conversations(table).collect()
    monkeypatch.setattr(conversations, "PIECE_TURNS", 7)
    assert whole == conversations.repair_conversations(table).collect()
    cells = conversations.Spans()
    for _, role, _, fault in faults([r[1:] for r in rows]):
        kind = {"": 0, "blank": 1, "truncated": 2, "duplicate": 3}[fault]
        cells.spans.append((1, conversations.CELLS[role[0], kind]))  # one after the other, from the right
    assert conversations.best_parse(cells.whole()) == (whole[0]["cost"], whole[0]["audit"])


def test_repaired_turns_follow_the_audit(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "assistant", "b"), (2, 0, "user", "q?"), (2, 1, "user", " ")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    report = conversations.conversation_report(table)
    turns = conversations.repaired_turns(table, report).orderBy("conv_id", "place").collect()
    assert [tuple(t) for t in turns] == [
        (1, 0, "K", 0, "system", "s."), (1, 1, "R", 1, "user", "a."), (1, 2, "K", 2, "assistant", "b"),
        (2, 0, "K", 0, "user", "q?"), (2, 1, "I", None, "assistant", ""),
    ]


def test_conversations_without_turns_and_empty_tables(spark):
    none = spark.createDataFrame([], TURNS)
    assert conversations.repair_conversations(none).collect() == []
    got = conversations.repair_conversations(none, spark.createDataFrame([(1,), (None,), (1,)], "conv_id bigint")).collect()
    assert sorted((r["conv_id"] or 0, r["cost"], r["gaps"], r["audit"]) for r in got) == [(0, 0, 0, ""), (1, 0, 0, "")]
    assert {r["repaired_sha256"] for r in got} == {hashlib.sha256().hexdigest()}
    assert conversations.damaged(none).columns == ["conv_id", "turn", "role", "text"]
    nulls = spark.createDataFrame([(None, None, None, None, None, None, None)] * 3, TURNS)
    row = conversations.repair_conversations(nulls).collect()[0]
    assert (row["blank"], row["illegal"], row["cost"], row["audit"], row["gaps"]) == (3, 2, 12, "DDD", 0)


def test_string_ids_and_a_very_long_text(spark):
    rows = [("b", 0, "user", "x" * 3_000_000 + "."), ("b", 1, "assistant", "fine."), (" ", 0, "user", "a.")]
    table = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {r["conv_id"]: r for r in conversations.repair_conversations(table).collect()}
    assert got["b"]["audit"] == "KK" and got[" "]["audit"] == "KI"


# --- 12: licenses ------------------------------------------------------------------


def brute_licenses(text):
    words = [w.decode() for w in licenses.words_of(text or "")]
    base = [
        (i, label)
        for label, phrase in licenses.PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    notices = []
    for k in range(0, max(1, -(-len(words) // licenses.STEP))):
        start = k * licenses.STEP
        if k and start + licenses.BLOCK_WORDS - licenses.STEP >= len(words):
            break
        block = set(words[start : start + licenses.BLOCK_WORDS])
        for n, (label, template) in enumerate(licenses.TEMPLATES):
            needed = {w.decode() for w in licenses.words_of(template)}
            if 100 * len(needed & block) >= licenses.THRESHOLD * len(needed):
                notices.append((k, n, label, len(needed & block) / len(needed)))
    return len(words), base, notices


def licensed_texts():
    rng = random.Random(3)
    filler = [f"w{i}" for i in range(50)] + ["the", "of", "license", "under", "software", "Free", "é"]
    texts = [None, "", "!!", "MIT License", "mit, license mit-LICENSE general public license", "the MIT\nLicense " * 30]
    for _ in range(300):
        words = [rng.choice(filler) for _ in range(rng.randrange(0, 150))]
        for _ in range(rng.randrange(0, 3)):
            notice = licenses.TEMPLATES[rng.randrange(len(licenses.TEMPLATES))][1].split()
            notice = [w if rng.random() > 0.08 else "changed" for w in notice]
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        texts.append(rng.choice([" ", "\n", " / "]).join(words))
    texts.append(" ".join(texts[10:]) + " z" * 200_000)
    return texts


def test_licenses_match_a_comparison_of_all_blocks_with_all_templates(spark):
    texts = licensed_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("blocks", F.lit("x"))
    got = {r["doc_id"]: r for r in licenses.find_licenses(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        n_words, base, notices = brute_licenses(text)
        row, places = got[i], [at for at, _ in base]
        assert (row["n_words"], row["n_base"]) == (n_words, len(base))
        assert (row["first_word"], row["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert [tuple(n) for n in row["notices"]] == notices
        assert row["labels"] == sorted({x for _, x in base} | {n[2] for n in notices})
        assert row["score"] == (1.0 if base else max((n[3] for n in notices), default=0.0))


def test_a_passage_stands_whole_in_a_block_wherever_it_is(spark):
    notice = max((t for _, t in licenses.TEMPLATES), key=lambda t: len(t.split()))
    docs = spark.createDataFrame([(n, "x " * n + notice + " y" * (130 - n)) for n in range(0, 130, 3)], "doc_id bigint, text string")
    assert {max(x["share"] for x in r["notices"]) for r in licenses.find_licenses(docs).collect()} == {1.0}


def test_licenses_of_odd_tables(edge_docs, no_docs):
    rows = licenses.find_licenses(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert licenses.find_licenses(no_docs).collect() == []
    empty = [r for r in rows if r["doc_id"] in (4, 5, 6)]
    assert [(r["n_words"], r["labels"], r["score"]) for r in empty] == [(0, [], 0.0)] * 3
    with pytest.raises(ValueError, match="words"):
        licenses.find_licenses(no_docs, templates=(("long", "word " * 40),))


# --- 13: importance resampling -----------------------------------------------------


def features_of(text, run):
    words = (text or "").encode().translate(licenses.FOLDED).split()
    runs = [b" ".join(words[i : i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f) for f in runs]


@pytest.mark.parametrize(("run", "size"), [(1, 50), (3, 1 << 20), (2, 100)])
def test_buckets_are_those_of_the_runs_cut_out(spark, edge_docs, monkeypatch, run, size):
    monkeypatch.setattr(resampling, "DICTIONARY_BYTES", size)
    monkeypatch.setattr(resampling, "DICTIONARY_WORDS", size)
    docs = edge_docs.select("doc_id", "text", "row")
    got = resampling.feature_buckets(docs, run, 977).collect()
    found = sorted((str(r["doc_id"]), r["n_words"], sorted(np.frombuffer(r["buckets"], "<u4").tolist())) for r in got)
    expected = []
    for r in docs.collect():
        n, crcs = features_of(r["text"], run)
        expected.append((str(r["doc_id"]), n, sorted(c % 977 for c in crcs)))
    assert found == sorted(expected)
    assert "row" in got[0]


def test_draw_matches_brute_force(spark, documents, sf):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = documents.collect()
    raw, target = Counter(), Counter()
    for texts, sums in ((rows, raw), (benchmark.collect(), target)):
        for r in texts:
            sums.update(c % 500 for c in features_of(r["text"], 2)[1])
    s, t = sum(raw.values()), sum(target.values())
    scored = []
    for r in rows:
        n, crcs = features_of(r["text"], 2)
        gains = [math.floor(1000 * math.log((target[c % 500] + 1) * (s + 500) / ((raw[c % 500] + 1) * (t + 500)))) for c in crcs]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{r['doc_id']}".encode()).hexdigest()[:8], 16)
        scored.append((r["doc_id"], n, len(crcs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((x for x in scored if x[1] >= 30), key=lambda x: (-x[4], x[0]))
    ranks = {x[0]: i + 1 for i, x in enumerate(able[: len(able) * 25 // 100])}
    got = resampling.draw_documents(documents, benchmark, 2, 500, 7, 30, 25).collect()
    assert sorted(map(tuple, got)) == sorted((i, f, w, sc, ranks.get(i)) for i, _, f, w, sc in scored)


def test_draw_from_odd_tables(spark, edge_docs, no_docs):
    assert resampling.draw_documents(no_docs, no_docs).collect() == []
    got = resampling.draw_documents(edge_docs, no_docs, min_words=0, percent=100).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, edge_docs.count() + 1))
    by_rank = sorted(got, key=lambda r: r["rank"])
    assert [r["score"] for r in by_rank] == sorted((r["score"] for r in got), reverse=True)
    assert all(r["weight"] == 0 for r in got if not r["n_features"])
    same = spark.createDataFrame([(1, "a b c")] * 40, "doc_id bigint, text string")
    ranks = [r["rank"] for r in resampling.draw_documents(same, same, min_words=1).collect()]
    assert sorted(r for r in ranks if r) == [1, 2, 3, 4]


def test_crc_of_a_concatenation():
    rng = np.random.default_rng(2)
    parts = [(rng.bytes(n), rng.bytes(m)) for n, m in ((0, 1), (3, 0), (5, 7), (40, 300), (1, 70_000))]
    shifts = resampling.Shifts()
    left, right = (np.array([zlib.crc32(p[i]) for p in parts], np.uint32) for i in (0, 1))
    got = shifts.composed(left, right, np.array([len(b) for _, b in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]
