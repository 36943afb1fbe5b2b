import random
from collections import Counter
from hashlib import sha256

import pytest
from helpers import ODD_TEXTS, docs, empty, prose

from tidemark.llm import common, pfparse, queries


def plain(texts, length):
    counts = Counter(t[x : x + length] for t in texts for x in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = set()
        for x in range(len(t) - length + 1):
            if counts[t[x : x + length]] > 1:
                gone.update(range(x, x + length))
        out.append((len(t), bytes(c for k, c in enumerate(t) if k not in gone), sum(k - 1 not in gone for k in gone)))
    return out


def planted():
    r = random.Random(0)
    passage, line = prose(1, 60, 10**6), prose(2, 20, 10**6)
    texts = [prose(k, r.randrange(1, 80), 10**6) for k in range(100, 130)]
    for k in range(0, 30, 2):
        cut = r.randrange(len(texts[k]) + 1)
        texts[k] = texts[k][:cut] + passage[r.randrange(60) : len(passage) - r.randrange(60)] + texts[k][cut:]
    for k in range(0, 30, 3):
        texts[k] += line + texts[k][:5]
    texts += [texts[3]] * 4 + ["a" * 700, "b" + "a" * 650, "ab" * 300, "ab" * 120 + "c", "é" * 300, passage + passage]
    return [(1000 + k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("length,reach,group_rows", [(100, 32, 8192), (100, 32, 2), (101, 64, 40), (60, 16, 8192)])
def test_removal_equals_brute_force(spark, length, reach, group_rows):
    rows = [x for x in ODD_TEXTS if x[0] != 8] + planted()
    got = pfparse.remove_repeats(docs(spark, rows), length=length, reach=reach, group_rows=group_rows).collect()
    want = plain([(t or "").encode() for _, t in rows], length)
    assert Counter((str(r["doc_id"]), r["bytes"], bytes(r["kept"]), len(r["spans"])) for r in got) == Counter(
        (str(i), *w) for (i, _), w in zip(rows, want)
    )
    assert sum(len(r["spans"]) for r in got) > 20


def test_a_very_long_text_of_one_word_goes(spark):
    got = pfparse.remove_repeats(docs(spark, [(1, "word " * 30_000), (2, "clean " * 50), (3, None)])).collect()
    assert {r["doc_id"]: len(r["kept"]) for r in got} == {1: 0, 2: 300, 3: 0}


def test_empty_table(spark):
    assert pfparse.remove_repeats(empty(spark)).count() == 0


def test_buckets_follow_the_bytes_and_leave_no_table(spark, monkeypatch):
    monkeypatch.setattr(common, "BUCKET_BYTES", 1000)
    rows = docs(spark, [(k, prose(k, 300)) for k in range(60)]).select("doc_id", "text")
    held = common.bucketed(rows, "doc_id", "text", "held")
    n = int(rows.selectExpr("ceil(sum(octet_length(text)) / 1000)").first()[0])
    assert n > 60 and not spark.catalog.listTables(pattern="held_*")
    joined = held.join(spark.range(60).withColumnRenamed("id", "doc_id").hint("merge"), "doc_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and f"SelectedBucketsCount: {n} out of {n}" in plan
    assert joined.count() == 60


def test_query_equals_a_count_of_every_400_bytes(spark, tmp_path):
    """The driver's rows, and passages of 51 words in two texts each: one of 399 bytes, which stays, and one of 400."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    words = prose(5, 51, 10**5)
    for k, size in enumerate((399, 400)):
        # The spaces at both ends count; a last word of its own keeps the passages apart.
        passage = f" {words}{'ab'[k] * (size - 2 - len(words))} "
        assert len(passage) == size and len(passage.split()) == 51
        rows += [(10**6 + 2 * k + j, f"{prose(10 + 2 * k + j, 60, 10**6)} {'xy'[j]}{passage}{'yx'[j]} end {k} {j}") for j in range(2)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op5_substring_dedup"](spark, str(tmp_path)).collect()}
    assert [got[10**6 + k][1] for k in range(4)] == [0, 0, 400, 400]
    want = plain([(t or "").encode() for _, t in rows], 400)
    assert got == {i: (n, n - len(kept), spans, sha256(kept).hexdigest()) for (i, _), (n, kept, spans) in zip(rows, want, strict=True)}


def rows_read(spark) -> dict[tuple[int, int], list[int]]:
    """Rows that the tasks of each stage so far have read from shuffles."""
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    none = gateway.jvm.java.util.ArrayList()
    stages = store.stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
    out = {}
    for s in (stages.apply(k) for k in range(stages.size())):
        tasks = store.taskList(s.stageId(), s.attemptId(), 10_000) if s.shuffleReadRecords() else none
        metrics = [tasks.apply(k).taskMetrics() for k in range(tasks.size())]
        out[s.stageId(), s.attemptId()] = [m.get().shuffleReadMetrics().recordsRead() for m in metrics if m.isDefined()]
    return out


@pytest.mark.parametrize("tails,group_rows", [(0, 8192), (1, 2)])
def test_no_task_reads_all_rows_of_a_frequent_passage(spark, tails, group_rows):
    """2,000 copies of one text, and a passage before 2,000 tails of their own, in 64 partitions."""
    passage = prose(3, 40, 10**6)
    texts = [passage + (f" {prose(100 + k, 12, 10**6)}" if tails else "") for k in range(2000)]
    before = set(rows_read(spark))
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    were = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = pfparse.remove_repeats(docs(spark, list(enumerate(texts))), length=100, reach=32, group_rows=group_rows)
        got = {r["doc_id"]: (r["bytes"], bytes(r["kept"]), len(r["spans"])) for r in got.collect()}
    finally:
        for k, v in were.items():
            spark.conf.set(k, v)
    assert got == dict(enumerate(plain([t.encode() for t in texts], 100)))
    assert max(max(v) for k, v in rows_read(spark).items() if k not in before and v) < 1500
