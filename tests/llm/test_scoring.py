"""Operators that score or measure each text: 1, 3, 4, 7, 10."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptmill.llm import common, language_id, lm_scoring, quality_rules, token_counts, toxicity


def low(text):
    return (text or "").encode().lower().split()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- 1: hidden Markov scores ---------------------------------------------------


def test_lm_base_matches_brute_force_with_a_small_memory(documents, monkeypatch):
    monkeypatch.setattr(lm_scoring, "KNOWN_WORDS", 300)  # most counts now come by the join
    monkeypatch.setattr(lm_scoring, "REMEMBERED_WORDS", 2000)
    rows = documents.select("doc_id", "text").collect()
    counts = Counter()
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            counts.update([*low(r["text"]), b" "])
    total, distinct = sum(counts.values()), len(counts)
    got = by_id(lm_scoring.score_texts(documents, rounds=1, states=3))
    assert len(got) == len(rows)
    for r in rows:
        words, row = [*low(r["text"]), b" "], got[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        assert row["base_score"] == pytest.approx(base)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), total)
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())


def test_lm_words_never_seen_are_no_likelier_than_seen_ones(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "OWN_CODES", 8)
    train = [(i, " ".join(f"w{(i * 7 + j) % 300}ing" for j in range(30))) for i in range(200)]
    seen, unseen = (10_000, "w5ing"), (10_001, "neverseening")
    got = by_id(lm_scoring.score_texts(spark.createDataFrame([*train, seen, unseen], "doc_id bigint, text string"), 1, 2))
    assert got[10_000]["n_known"] == 2 and got[10_001]["n_known"] in (1, 2)
    assert got[10_000]["score"] >= got[10_001]["score"]


def test_lm_scores_do_not_depend_on_which_counts_are_held(documents, monkeypatch):
    few = documents.where("doc_id < 40")
    whole = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(few, 1, 3).collect()}
    monkeypatch.setattr(lm_scoring, "KNOWN_WORDS", lm_scoring.OWN_CODES)
    part = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(few, 1, 3).collect()}
    assert part == pytest.approx(whole)


def test_forward_recursion_sums_over_all_paths():
    rng = np.random.default_rng(1)
    model = lm_scoring.Model(
        rng.dirichlet(np.ones(2)), rng.dirichlet(np.ones(2), 2), np.vstack([rng.random((lm_scoring.CODES, 2)) / 100, np.ones(2)])
    )
    first, second = np.array([3, 5, 7, 9]), np.array([4])
    codes = lm_scoring.padded([first, second])

    def brute(seq):
        total = 0.0
        for path in np.ndindex(*[2] * len(seq)):
            p = model.start[path[0]] * model.emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= model.move[path[t - 1], path[t]] * model.emit[seq[t], path[t]]
            total += p
        return math.log10(total)

    assert lm_scoring.likelihood(codes, model) == pytest.approx([brute(first), brute(second)])
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((lm_scoring.CODES, 2))
    lm_scoring.expected_counts(codes, model, start, move, emit)
    assert (start.sum(), move.sum(), emit.sum()) == pytest.approx((2, 3, 5))


def test_lm_edges(edge_docs, no_docs):
    rows = lm_scoring.score_texts(edge_docs, 1, 2).collect()
    assert len(rows) == 12
    got = {r["doc_id"]: r for r in rows}
    assert got[4]["n_tokens"] == got[5]["n_tokens"] == got[6]["n_tokens"] == 1
    assert got[8]["n_tokens"] == 60_002 and math.isfinite(got[8]["score"])
    assert got[None]["held_out"] is False
    assert lm_scoring.score_texts(no_docs, 1, 2).collect() == []


# --- 3: quality ------------------------------------------------------------------


def brute_quality(rows, trusted):
    def bucket(word):
        return int.from_bytes(hashlib.md5(word).digest()[:4])

    def grams(text):
        hashes = [bucket(w) for w in (text or "").encode().split()]
        size = quality_rules.BUCKETS
        return [h % size for h in hashes] + [(a * 31 + b) % size for a, b in zip(hashes, hashes[1:], strict=False)]

    raw, target = Counter(), Counter()
    for doc_id, text in rows:
        raw.update(grams(text))
        if doc_id in trusted:
            target.update(grams(text))
    r, t, size = sum(raw.values()), sum(target.values()), quality_rules.BUCKETS
    out = {}
    for doc_id, text in rows:
        words, text = (text or "").encode().split(), text or ""
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        base = (
            len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered),
        )
        found = grams(text)
        llr = sum(math.log((target[g] + 1) / (t + size)) - math.log((raw[g] + 1) / (r + size)) for g in found)
        llr = llr / len(found) if found else 0.0
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        out[doc_id] = (*base, llr, failed, not failed and llr >= quality_rules.THRESHOLD)
    return out


def check_quality(docs, labels, trusted):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    expected = brute_quality(rows, trusted)
    got = quality_rules.score_quality(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        want = expected[r["doc_id"]]
        assert tuple(r)[1:6] == want[:5] and r["llr"] == pytest.approx(want[5]) and tuple(r)[7:] == want[6:]


def test_quality_matches_brute_force(spark, sf, documents):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    check_quality(documents, labels, {r["doc_id"] for r in labels.where("quality = 1").collect()})


def test_quality_edges(edge_docs, no_docs, labels, no_labels):
    check_quality(edge_docs, labels, {1, 2})
    assert quality_rules.score_quality(no_docs, no_labels).collect() == []
    kept = quality_rules.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {
        r["doc_id"] for r in quality_rules.score_quality(edge_docs, labels).where("kept").collect()
    }


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_trusted_ids_are_exact(spark, kind):
    first = 1 << 53
    texts = [(first, "good words here"), (first + 1, "bad words there")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    marks = spark.createDataFrame([(first + 1, 1), (first + 2, 1)], "doc_id bigint, quality int")
    ratios = quality_rules.log_ratios(docs, marks.withColumn("doc_id", F.col("doc_id").cast(kind)))
    memory = quality_rules.Words()
    good, bad = (ratios[memory.of([w])[1] % quality_rules.BUCKETS][0] for w in (b"good", b"bad"))
    assert bad > good
    assert [r["doc_id"] for r in quality_rules.score_quality(docs, marks.limit(0)).select("doc_id").collect()] == [
        r["doc_id"] for r in docs.collect()
    ]


# --- 4: toxicity ------------------------------------------------------------------


def test_disguised_words_are_restored(spark):
    prose = [("the idiot and the stupid clown were loud",)] * 30 + [("green fields and quiet rivers",)] * 30
    costs = toxicity.character_model(spark.createDataFrame(prose, "text string"))
    for disguise, word in ((b"1d10t", b"idiot"), (b"stuuuupid", b"stupid"), (b"st.up.id", b"stupid"), (b"cl0wn", b"clown")):
        assert word + b" " in toxicity.features(disguise, costs)
    assert b"idiot" in toxicity.tokens(b"what an I D I O T you are")


def test_restored_words_are_the_cheapest_of_all_ways_through_the_lattice():
    rng = np.random.default_rng(4)
    costs = rng.random(toxicity.SYMBOLS**3).tolist()
    for _ in range(300):
        word = b"".join(bytes([rng.choice(list(b"ab01!*.-_@\xc3"))]) * int(rng.integers(1, 4)) for _ in range(rng.integers(1, 5)))
        places = [p for m in re.finditer(rb"(.)\1*", word, re.S) for p in toxicity.run_places(m.group(1), len(m.group()))]
        best = {}
        for way in itertools.product(*places):
            text = b"".join(letter for letter, _, _ in way)
            codes = [0, 0, *toxicity.CODES[list(text)].tolist(), 0] if text else [0, 0, 0]
            spent = sum(price for _, _, price in way)
            spent += sum(costs[(a * 32 + b) * 32 + c] for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))
            best[text] = min(spent, best.get(text, spent))
        assert best[toxicity.restored(word, costs)] == pytest.approx(min(best.values()))


def test_long_words_short_rows_and_joints(spark):
    costs = toxicity.character_model(spark.createDataFrame([("the idiot is a fool",)] * 30, "text string"))
    assert b"idiot " in toxicity.features(b"i" * 60 + b"d" * 30 + b"1ot", costs)
    assert toxicity.restored(b"1d10t" * 20_000, costs).count(b"idiot") == 20_000
    assert b"you" in toxicity.tokens(b"so  y o u") and b"idiot" in toxicity.tokens(b"i -d - i\to.\nt")
    assert {b"some ", b"idiot "} <= toxicity.features(b"some-1d10t,", costs) | toxicity.features(b"idiot-some", costs)


def test_lexicon_finds_what_the_features_say():
    costs = [0.1] * toxicity.SYMBOLS**3
    known = toxicity.Lexicon({b"grum": 0.8, b"bad ": 0.9, b"fooli": 0.7})
    for word in (b"grumble", b"b4d", b"bad!", b"foolish", b"grammar", b"", b"x-bad"):
        assert known.best(word, costs) == max((known.shares.get(f, 0.0) for f in toxicity.features(word, costs)), default=0.0)


def test_toxicity_learns_words_and_their_beginnings(spark):
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        word = ["grumble", "grumblers", "grumbling"][i // 4 % 3] if toxic else "pleasant"
        rows.append((i, f"this is a {word} remark number {i * 7919 % 1000}"))
        marks.append((i, 1, int(toxic)))
    rows.append((1000, "what a g r u m b l e this is"))
    rows.append((1001, "we saw a grumbl3 here"))
    rows.append((1002, "they are grumblesome"))
    rows.append((1003, "a pleasant day"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = by_id(toxicity.score_toxicity(docs, spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")))
    wrong = [i for i, _, toxic in marks if got[i]["held_out"] and got[i]["predicted"] != toxic]
    assert wrong == [] and any(got[i]["held_out"] for i in range(400))
    assert [got[i]["predicted"] for i in (1000, 1001, 1002, 1003)] == [1, 1, 1, 0]


def test_toxicity_edges(edge_docs, no_docs, labels, no_labels):
    rows = toxicity.score_toxicity(edge_docs, labels).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in toxicity.score_toxicity(edge_docs, no_labels).collect()} == {toxicity.FLOOR}
    assert toxicity.score_toxicity(no_docs, labels).collect() == []


# --- 7: lengths -----------------------------------------------------------------


def test_histogram_matches_direct_sums(edge_docs, documents, no_docs):
    encode = token_counts._encoder(open(token_counts.TOKENIZER, "rb").read()).encode_ordinary
    for docs in (documents, edge_docs):
        lengths = [len(encode(r["text"] or "")) for r in docs.select("text").collect()]
        rows = token_counts.length_histogram(docs).collect()
        assert {r["n_tokens"]: r["n_docs"] for r in rows} == Counter(lengths)
        for r in rows:
            n = r["n_tokens"]
            longer = [x for x in lengths if x >= n]
            assert (r["docs_from"], r["tokens_from"]) == (len(longer), sum(longer))
            assert r["truncated_total"] == sum(min(x, n) for x in lengths)
            assert r["share_within"] == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
            assert (r["docs_total"], r["tokens_total"]) == (len(lengths), sum(lengths))
        histogram = token_counts.length_histogram(docs)
        limits = {r["context_limit"]: (r["total"], r["n_cut"]) for r in token_counts.truncated_totals(histogram, [0, 10, 333]).collect()}
        assert limits == {m: (sum(min(x, m) for x in lengths), sum(x > m for x in lengths)) for m in (0, 10, 333)}
        half = token_counts.length_quantiles(histogram, [0.5]).collect()[0]["n_tokens"]
        assert half == sorted(lengths)[(len(lengths) - 1) // 2]
    assert token_counts.length_histogram(no_docs).collect() == []


# --- 10: languages ------------------------------------------------------------------


def test_language_accuracy_on_held_out(documents):
    truth = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    rows = [r for r in language_id.identify_languages(documents).collect() if r["held_out"]]
    assert len(rows) > 30 and sum(truth[r["doc_id"]] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_language_edges(edge_docs, no_docs):
    got = by_id(language_id.identify_languages(edge_docs))
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (4, 5, 6, 7))
    assert got[1]["lang_pred"] == "en" and 0 < got[1]["score"] <= 1
    assert language_id.identify_languages(edge_docs).count() == 12
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify_languages(unlabelled).collect()} <= {"und"}
    assert language_id.identify_languages(no_docs).collect() == []


# --- shared helpers ---------------------------------------------------------------------


def test_bounded_samples(spark):
    ids = spark.range(5000).select(F.col("id").alias("doc_id"))
    some = [r[0] for r in common.hash_sample(ids, 700).collect()]
    assert len(some) == len(set(some)) == 700
    assert set(some) <= {r[0] for r in common.hash_sample(ids, 900).collect()}
    assert common.hash_sample(ids, 10_000).count() == 5000
    counts = spark.createDataFrame([(i, i % 5, 1 + 1000 // (i + 1)) for i in range(200)], "hash bigint, ending smallint, n bigint")
    hashes, n, endings = lm_scoring.frequent(counts, 20)
    assert 10 <= hashes.size <= 20 and hashes.tolist() == list(range(hashes.size))
    assert n.tolist() == [1 + 1000 // (i + 1) for i in hashes] and endings.tolist() == [i % 5 for i in hashes]


def test_bit_filter_misses_nothing(spark):
    values = [((i * 0x9E3779B97F4A7C15) % (1 << 64)) - (1 << 63) for i in range(2000)]
    packed = common.bit_filter(spark.createDataFrame([(x,) for x in values[:1000]], "h bigint"), 16)
    held = common.may_hold(packed, np.array(values, np.int64).view(np.uint64))
    assert held[:1000].all() and held[1000:].mean() < 0.05
