"""Streams give what the batch jobs give."""

import json
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from conftest import content
from pyspark.sql import functions as F
from test_ga4 import ITEM, TS

from tidemark.operators import ingest, sessions
from tidemark.options import Options
from tidemark.plans.gold import materialize
from tidemark.plans.silver import run_silver
from tidemark.session import scratch_dir
from tidemark.sources import events as ev
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming import jobs
from tidemark.streaming import sessions as streamed

MINUTE = 60_000_000


def write_files(folder, files):
    folder.mkdir()
    for n, lines in enumerate(files):
        (folder / f"batch_{n}.jsonl").write_text("\n".join(lines) + "\n")
    return str(folder)


def line(minute, name="view_item", user="u", product="P1", platform="IOS"):
    return json.dumps(
        {
            "event_timestamp": TS + int(minute * MINUTE), "user_id": user, "event_name": name,
            "platform": platform, "items": f"[{ITEM.replace('P1', product)}]",
        }
    )


FILES = [
    [line(0), line(3, "begin_checkout"), "broken"],
    [line(50), line(25, product="P2"), line(0), line(1, user=None)],
    [line(500, "purchase"), line(90, user="v", platform="android"), line(75)],
]


def test_stream_equals_batch(spark, tmp_path):
    raw = write_files(tmp_path / "raw", FILES)
    stream = Warehouse(spark, str(tmp_path / "stream"))
    jobs.run_pipeline_stream(stream, ev.stream_events(spark, raw, max_files=1), str(tmp_path / "mark"))
    assert stream.committed() == 3
    assert spark.read.json(stream.path("dead_letters")).count() == 1

    batch = Warehouse(spark, str(tmp_path / "batch"))
    good, _ = ingest.validate(ingest.flatten_events(ev.read_events(spark, raw)[0], datetime(2025, 1, 2)))
    ev.append_staging(good, batch.path("stg_events"))
    run_silver(batch)
    for table in ("silver_user_sessions", "silver_session_features", "fct_product_daily_performance"):
        assert content(stream.table(table)) == content(batch.table(table)), table
    assert stream.table("fct_events").count() == 8

    # Draining again finds nothing new.
    jobs.run_pipeline_stream(stream, ev.stream_events(spark, raw, max_files=1), str(tmp_path / "mark"))
    assert stream.committed() == 3


def test_messages_are_deduplicated_across_files(spark, tmp_path):
    folder = tmp_path / "m"
    folder.mkdir()
    for n in range(3):
        rows = [{"id": i, "at": f"2025-01-01 00:0{n}:00"} for i in range(n, n + 4)]
        (folder / f"{n}.json").write_text("\n".join(map(json.dumps, rows)))
    stream = spark.readStream.schema("id int, at timestamp").option("maxFilesPerTrigger", 1).json(str(folder))
    out = str(tmp_path / "out")
    jobs.write_available(jobs.dedup_messages(stream, "id"), out, str(tmp_path / "mark"))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4, 5]


def test_a_first_arrival_is_never_too_late(spark, tmp_path):
    folder = tmp_path / "late"
    folder.mkdir()
    for n, (i, day) in enumerate([(1, "2025-02-01"), (3, "2025-02-01"), (4, "2025-02-01"), (2, "2025-01-01"), (1, "2025-01-01")]):
        (folder / f"{n}.json").write_text(json.dumps({"id": i, "at": f"{day} 00:00:00"}))
    stream = spark.readStream.schema("id int, at timestamp").option("maxFilesPerTrigger", 1).json(str(folder))
    out = str(tmp_path / "out")
    jobs.write_available(jobs.dedup_messages(stream, "id"), out, str(tmp_path / "mark"))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]


ROWS = "event_id string, event_name string, event_timestamp timestamp_ntz, user_id string, platform_id int, note string"
SESSION_COLUMNS = ("user_id", "platform_id", "session_start_ts", "session_end_ts", "events_in_session", "views")


def arrive(spark, folder, minutes, user="u", platform=1, tag=""):
    start = datetime(2025, 1, 1)
    rows = [(f"{tag}{m}", "view_item", start + timedelta(minutes=m), user, platform, "kept") for m in minutes]
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(folder)


def streamed_all(spark, root):
    return streamed.closed_sessions(spark, root).unionAll(streamed.open_sessions(spark, root))


def drain_sessions(spark, tmp_path, delay):
    schema = spark.createDataFrame([], ROWS).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streamed.sessionize_stream(stream, str(tmp_path / "out"), str(tmp_path / "mark"), 30, delay)


def batch_sessions(spark, df):
    return sessions.user_sessions(sessions.sessionize(df, 30))


def test_closed_open_and_late_are_everything(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    # 41 and 300 come more than two hours behind the latest row before them.
    for minutes in ([0, 12, 70, 75, 500], [41, 530, 600], [300, 545, 900], [905, 906]):
        arrive(spark, folder, minutes)
    drain_sessions(spark, tmp_path, "120 minutes")
    everything = spark.read.parquet(folder)
    late = streamed.late_rows(spark, root, everything.schema)
    assert sorted((r["event_id"], r["note"]) for r in late.collect()) == [("300", "kept"), ("41", "kept")]
    on_time = everything.join(late, "event_id", "left_anti")
    assert content(streamed_all(spark, root), *SESSION_COLUMNS) == content(batch_sessions(spark, on_time), *SESSION_COLUMNS)
    assert streamed.closed_sessions(spark, root).count() == 4 and streamed.open_sessions(spark, root).count() == 1
    counted = streamed_all(spark, root).agg({"events_in_session": "sum"}).first()[0]
    assert counted + late.count() == everything.count()


def test_late_arrivals_within_the_delay_join_their_session(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    for minutes in ([0, 60, 200], [30, 90, 230], [215]):
        arrive(spark, folder, minutes)
    arrive(spark, folder, [10, 20], user=None)
    drain_sessions(spark, tmp_path, "10 hours")
    assert streamed.late_rows(spark, root, ROWS).count() == 0 and streamed.closed_sessions(spark, root).count() == 0
    assert content(streamed_all(spark, root), *SESSION_COLUMNS) == content(
        batch_sessions(spark, spark.read.parquet(folder)), *SESSION_COLUMNS
    )


def test_a_batch_played_again_changes_nothing(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, folder, [0, 5, 400])
    drain_sessions(spark, tmp_path, "1 hour")
    arrive(spark, folder, [1, 410, 800])
    more = spark.read.parquet(folder).filter("event_id IN ('1', '410', '800')")
    # The second batch dies after writing its tables, then runs from the checkpoint.
    streamed._session_batch(root, 30, "1 hour", more, 1)
    before = content(streamed_all(spark, root)), content(streamed.late_rows(spark, root, more.schema))
    drain_sessions(spark, tmp_path, "1 hour")
    assert before == (content(streamed_all(spark, root)), content(streamed.late_rows(spark, root, more.schema)))
    assert streamed.late_rows(spark, root, more.schema).count() == 1


def test_streamed_sessions_of_nothing(spark, tmp_path):
    root = str(tmp_path / "none")
    assert streamed_all(spark, root).count() == 0 and streamed.late_rows(spark, root, ROWS).count() == 0
    arrive(spark, str(tmp_path / "in"), [3], user=None)
    drain_sessions(spark, tmp_path, "1 hour")
    arrive(spark, str(tmp_path / "in"), [5])
    drain_sessions(spark, tmp_path, "1 hour")
    assert streamed_all(spark, str(tmp_path / "out")).count() == 1


def envelope(n, text):
    return json.dumps({"MessageId": f"m{n}", "Body": text})


def test_doubled_messages_give_one_set_of_facts_across_a_restart(spark, tmp_path):
    raw = tmp_path / "raw"
    first = [envelope(0, line(0)), envelope(1, line(3, "begin_checkout")), envelope(0, line(0)), "no envelope", envelope(2, "broken")]
    write_files(raw, [first])
    wh, mark = Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "mark")

    def run():
        stream = ev.stream_messages(spark, str(raw), max_files=1)
        return jobs.run_pipeline_stream(wh, stream, mark, Options(), id_col="message_id")

    counts = [c for c in run() if c["lines"]]
    assert [c["lines"] for c in counts] == [4] and counts[0]["parse_dead"] == 2
    # The second file brings all again, and two new messages; the stream starts anew from its checkpoint.
    (raw / "later.jsonl").write_text("\n".join([*first, envelope(3, line(50)), envelope(4, line(1, user=None))]) + "\n")
    counts = [c for c in run() if c["lines"]]
    # A line that is no envelope has no id to be known by.
    assert [c["lines"] for c in counts] == [3]
    assert (counts[0]["net_new_rows"], counts[0]["no_user"], counts[0]["events_without_items"]) == (2, 1, 0)
    assert wh.table("stg_events").count() == wh.table("fct_events").count() == 4


def test_ids_are_forgotten_after_their_time(spark, tmp_path):
    raw = write_files(tmp_path / "raw", [[envelope(0, line(0))], [envelope(0, line(0))], [envelope(0, line(0))]])
    out = str(tmp_path / "out")
    stream = ev.stream_messages(spark, raw, max_files=1)
    jobs.write_available(jobs.dedup_messages(stream, "message_id", "0 seconds"), out, str(tmp_path / "mark"))
    assert 1 <= spark.read.parquet(out).count() <= 3


def test_a_micro_batch_played_again_doubles_nothing(spark, tmp_path):
    raw = write_files(tmp_path / "raw", FILES)
    lines = spark.read.text(raw).withColumn("filepath", F.lit("f"))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    first = jobs.ingest_batch(wh, lines, run_ts=datetime(2025, 1, 2), load="s-0")
    before = [content(wh.table(t)) for t in ("fct_events", "silver_user_sessions", "fct_product_daily_performance")]
    letters = content(spark.read.json(wh.path("dead_letters")), "stage", "error", "raw_event")
    # The second attempt runs on another day.
    again = jobs.ingest_batch(wh, lines, run_ts=datetime(2025, 1, 3), load="s-0")
    assert first["net_new_rows"] == 8 and again["net_new_rows"] == 0
    assert (first["lines"], first["parse_dead"], first["staged_rows"], first["invalid_rows"]) == (10, 1, 9, 0)
    assert wh.table("stg_events").count() == 9
    assert letters == content(spark.read.json(wh.path("dead_letters")), "stage", "error", "raw_event")
    assert before == [content(wh.table(t)) for t in ("fct_events", "silver_user_sessions", "fct_product_daily_performance")]
    jobs.ingest_batch(wh, lines, run_ts=datetime(2025, 1, 3), load="s-1")
    assert wh.table("stg_events").count() == 18


def test_materialize_replaces_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "gold")
    schema = "day string, n int"
    materialize(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], schema), path, "day")
    materialize(spark.createDataFrame([("a", 9)], schema), path, "day")
    assert {(r.day, r.n) for r in spark.read.parquet(path).collect()} == {("a", 9), ("b", 3)}
    materialize(spark.createDataFrame([("a", 7)], schema), path, "day", ["a", "b", "c"])
    assert {(r.day, r.n) for r in spark.read.parquet(path).collect()} == {("a", 7)}


class Session:
    """Only what the scratch folder is chosen from."""

    def __init__(self, folder, master="local[2]"):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = SimpleNamespace(master=master)


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(Session("/shared/area/"), "x").startswith("/shared/area/x-")
    assert scratch_dir(Session(None), "x") != scratch_dir(Session(None), "x")
    with pytest.raises(ValueError):
        scratch_dir(Session(None, "yarn"), "x")
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert folder is None or scratch_dir(spark, "x").startswith(folder)
