import random

import numpy as np
import pytest
from helpers import ODD_TEXTS, docs, empty, prose

from tidemark.llm import common, langid, linear, quality, toxicity


def test_ngram_ids_are_equal_only_for_equal_grams():
    ids = linear.ngram_ids(b"abcabc", (2, 3), 40)
    assert len(ids) == 5 + 4
    grams = [b"ab", b"bc", b"ca", b"ab", b"bc", b"abc", b"bca", b"cab", b"abc"]
    assert [[a == b for b in grams] for a in grams] == [[a == b for b in ids.tolist()] for a in ids.tolist()]
    assert len(linear.ngram_ids(b"", (1, 2), 10)) == 0
    assert linear.ngram_ids(b"a", (1, 2), 10).tolist() == linear.ngram_ids(b"a", (1,), 10).tolist()
    mark = np.random.default_rng(0).integers(-5, 5, 1 << 12).astype(np.int32)
    many = np.random.default_rng(1).integers(0, 300, 5000)
    assert sorted(linear.distinct(many, mark)) == sorted(set(many.tolist()))


def test_minimize_finds_a_quadratic_minimum():
    a = np.array([[3.0, 1, 0], [1, 2, 0.5], [0, 0.5, 1]])
    b = np.array([1.0, -2, 3])
    w = linear.minimize(lambda w: (0.5 * w @ a @ w - b @ w, a @ w - b), np.zeros(3), 100)
    assert np.allclose(w, np.linalg.solve(a, b), atol=1e-4)


def marked(n=900):
    """(rows, labels): every fourth text holds a bad word at any place, in either case; one label in forty is wrong."""
    r = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = prose(i, r.randrange(5, 200)).split()
        bad = i % 4 == 0
        if bad:
            words.insert(r.randrange(len(words)), r.choice(["grumblefoo", "GRUMBLEBAR", "snarkzig"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad) if i % 40 else 1 - int(bad), 9))
    return rows, labels + [(None, 1, 9), (5, None, 9), (6, 7, 9), (10**6, 1, 9)]


LABELS = "doc_id long, label int, text int"


def test_toxicity_finds_marked_texts(spark):
    rows, labels = marked()
    train = spark.createDataFrame([x for x in labels if x[0] is None or x[0] % 3 or x[0] >= 10**6], LABELS)
    frame = docs(spark, rows + ODD_TEXTS)
    # A tenth of the bad examples are labelled wrongly.
    model = toxicity.fit(frame, train, "label", penalty=1e-2)
    got = toxicity.score(frame, model).collect()
    assert len(got) == len(rows) + len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    held = [(i % 4 == 0, r["score"] >= 0.5) for (i, _), r in zip(rows, got) if i % 3 == 0]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    # A text alone decides its score, whatever else stands in its row.
    again = toxicity.score(frame.selectExpr("text", "0 AS doc_id"), model).select("score").collect()
    assert [r["score"] for r in again] == [r["score"] for r in got]


def test_quality_ranks_and_cuts_at_the_quantile(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        text = prose(i, r.randrange(10, 300))
        if i % 3 == 0:
            text = r.choice([text.upper().replace(" ", "!! "), text.replace(" ", "### "), "same " * 80, text.replace(" ", " | ")])
        rows.append((i, text))
        labels.append((i, int(i % 3 > 0), 0))
    frame = docs(spark, rows + ODD_TEXTS)
    train = spark.createDataFrame([x for x in labels if x[0] % 2] + [(None, 0, 0), (3, None, 0)], LABELS)
    model = quality.fit(frame, train, "label")
    got = quality.score(frame, model).collect()
    assert all(0 <= x["score"] <= 1 for x in got)
    kept = [(i % 3 > 0, x["score"] >= quality.KEEP_AT) for (i, _), x in zip(rows, got) if i % 2 == 0]
    assert sum(a == b for a, b in kept) >= 0.97 * len(kept)
    trained = [x["score"] for (i, _), x in zip(rows, got) if i % 2]
    assert abs(np.mean([s < quality.KEEP_AT for s in trained]) - 1 / 3) < 0.02


@pytest.mark.parametrize("given,want", [([], 0.5), ([(i, 1, 0) for i in range(8)], 0.9), ([(i, 0, 0) for i in range(8)], 0.1)])
def test_without_both_classes_scores_are_constant(spark, given, want):
    frame, train = docs(spark, [(i, prose(i, 20)) for i in range(8)] + ODD_TEXTS), spark.createDataFrame(given, LABELS)
    scores = {round(r["score"], 6) for r in toxicity.score(frame, toxicity.fit(frame, train, "label")).collect()}
    assert len(scores) == 1 and abs(scores.pop() - want) < 0.11
    scores = {r["score"] for r in quality.score(frame, quality.fit(frame, train, "label")).collect()}
    assert len(scores) == 1 and (scores.pop() >= quality.KEEP_AT) == (want >= 0.5)


def test_classifiers_on_empty_tables(spark):
    train = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], LABELS)
    for kind in (toxicity, quality):
        assert kind.score(empty(spark), kind.fit(empty(spark), train, "label")).count() == 0


def plain_viterbi(scores, switch):
    best, came = list(scores[0]), []
    for row in scores[1:]:
        top = max(range(len(best)), key=lambda k: best[k])
        came.append([k if best[k] >= best[top] - switch else top for k in range(len(best))])
        best = [max(best[k], best[top] - switch) + row[k] for k in range(len(best))]
    k = max(range(len(best)), key=lambda k: best[k])
    path = [k]
    for back in reversed(came):
        path.append(back[path[-1]])
    return path[::-1]


def test_viterbi_equals_the_plain_one():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 50, 1, 0, 17])
    scores = rng.normal(0, 3, (lengths.sum(), 4))
    got, at = langid.viterbi(scores, lengths, 4.0), 0
    for n in lengths.tolist():
        if n:
            assert got[at : at + n].tolist() == plain_viterbi(scores[at : at + n].tolist(), 4.0)
        at += n


GREEK, RUSSIAN = "αβγδε ζηθικ λμνξο", "вода небо земля огонь воздух"


def speech(kind, seed, n):
    r = random.Random(seed)
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ver", "ein"]}[kind]
    return " ".join("".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_languages_and_spans_of_mixed_texts(spark):
    rows = [(i, speech(k, i, 40), k) for i in range(60) for k in ("aa", "bb")] + [(900, GREEK * 5, "el"), (901, RUSSIAN * 5, "ru")]
    rows += [(902, None, "aa"), (903, "no lang", None), (904, "", "bb")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["aa", "bb", "el", "ru"]
    a, b = speech("aa", 1000, 30), speech("bb", 1001, 60)
    texts = [(1, a), (2, b.upper()), (3, f"{a}. {b}"), (4, RUSSIAN), (5, f"{b} {GREEK}!"), (6, "12 34 ?"), (7, None), (8, ""), (9, "日本語")]
    frame = docs(spark, texts + ODD_TEXTS).withColumnRenamed("row", "spans")
    got = langid.score(frame, model).collect()
    assert [r["lang_pred"] for r in got[:8]] == ["aa", "bb", "bb", "ru", "bb", "und", "und", "und"]
    mixed = [(s["lang"], texts[2][1][s["start"] : s["end"]]) for s in got[2]["spans"]]
    assert [k for k, _ in mixed] == ["aa", "bb"] and abs(len(mixed[0][1]) - len(a)) < 12
    assert [s["lang"] for s in got[4]["spans"]] == ["bb", "el"]
    assert [r["score"] for r in got[5:8]] == [0, 0, 0] and all(0 <= r["score"] <= 1 for r in got)
    assert got[8]["lang_pred"] in model.langs


def test_no_model_and_no_rows(spark):
    none = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert langid.fit(none) is None
    assert {r["lang_pred"] for r in langid.score(docs(spark, ODD_TEXTS), None).collect()} == {"und"}
    assert langid.score(empty(spark), None).count() == 0


def test_a_long_text_read_in_stretches_has_the_same_ngrams():
    mark = np.zeros(1 << 16, dtype=np.int32)
    text = prose(1, 3000).encode()
    whole = toxicity._ids(text, (3, 4, 5, 6), 16, mark)
    assert sorted(whole) == sorted(toxicity._ids(text, (3, 4, 5, 6), 16, mark, stretch=1000))


def test_quality_learns_and_cuts_over_all_labels(spark):
    rows = [(i, prose(i, 5 + i % 60, 50).replace(" ", "## " if i % 20 == 0 else " ")) for i in range(7000)]
    train = spark.createDataFrame([(i, int(i % 20 > 0), 0) for i, _ in rows], LABELS)
    frame = docs(spark, rows)
    model = quality.fit(frame, train, "label", block=1000)
    assert np.allclose(model.mean, np.mean([quality.features(t.encode()) for _, t in rows], axis=0))
    scores = [r["score"] for r in quality.score(frame, model).collect()]
    assert sum(s < quality.KEEP_AT for s in scores) == 350


@pytest.mark.parametrize("poor,good", [(3, 1000), (1000, 3), (40, 200), (1, 1)])
def test_blocks_hold_all_rows_and_both_labels(spark, poor, good):
    rows = spark.range(poor + good, numPartitions=5).selectExpr(
        "monotonically_increasing_id() AS row", f"int(id >= {poor}) AS label", "array(double(id)) AS x"
    )
    got = quality._blocks(common.stored(rows, "rows"), {0: poor, 1: good}, 50).collect()
    assert len(got) == -(-max(poor, good) // 50) and all(len(r["poor"]) and len(r["good"]) for r in got)
    for name, ids in (("poor", range(poor)), ("good", range(poor, poor + good))):
        held = [x[0] for r in got for x in r[name]]
        assert set(held) == set(ids) and len(held) == max(len(ids), len(got))


def test_nth_least_is_exact(spark):
    values = np.round(np.random.default_rng(0).normal(0, 1, 3000), 2).tolist() + [7.5] * 200 + [1e-9, 2e-9]
    frame = spark.createDataFrame([(v,) for v in values], "s double")
    for nth in (0, 1500, 1501, 3001, 3100, len(values) - 1):
        assert common.nth_least(frame, "s", nth, bins=4, most=20) == sorted(values)[nth]


def test_toxicity_counts_and_fits_over_all_labels(spark, monkeypatch):
    seen, counted, held = [], toxicity.gram_counts, toxicity._held
    monkeypatch.setattr(toxicity, "gram_counts", lambda rows, *a: seen.append(rows.count()) or counted(rows, *a))
    monkeypatch.setattr(toxicity, "_held", lambda rows, *a: seen.append(rows.count()) or held(rows, *a))
    rows = [(i, prose(i, 6, 50) + (" snarkzig" if i % 10 == 0 else "")) for i in range(7000)]
    frame = docs(spark, rows)
    model = toxicity.fit(frame, spark.createDataFrame([(i, int(i % 10 == 0), 0) for i, _ in rows], LABELS), "label", penalty=1e-3)
    assert seen == [7000, 7000]
    got = toxicity.score(frame, model).collect()
    assert all((r["score"] >= 0.5) == (i % 10 == 0) for (i, _), r in zip(rows, got))
    # At the least loss over all labels the mean score is the share of class 1 (smoothed).
    assert abs(np.mean([r["score"] for r in got]) - 701 / 7002) < 1e-3


def test_languages_are_counted_in_all_texts(spark):
    rows = [(i, speech("aa", i, 3) + " ΟΔΟΣ", "aa") for i in range(3300)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), bits=10)
    counts, table = np.zeros(1 << 10), langid.script_table()
    for _, text, _ in rows:
        start, end, _ = langid.words_in(text, table)
        np.add.at(counts, langid.word_grams([text[a:b] for a, b in zip(start, end)], langid.ORDERS, 10)[1], 1)
    assert np.allclose(model.logs[:, 0], np.log((counts + 0.5) / (counts.sum() + 0.5 * (1 << 10))), atol=1e-5)
