"""What the raw-line queries and the ingest store on the way."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog import ingest_queries as iq
from tidemark.plans import silver
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folders(monkeypatch, tmp_path):
    """Scratch folders by name, in the order they were made."""
    made = []

    def scratch(spark, name):
        made.append((name, str(tmp_path / f"{name}-{len(made)}")))
        return made[-1][1]

    monkeypatch.setattr(iq, "scratch_dir", scratch)
    monkeypatch.setattr(iq, "_WRITTEN", {})
    return made


@pytest.mark.parametrize("name", ["P6_flatten_events", "P10_backfill", "P3_parse_params", "P11_backfill_field"])
def test_parse_queries_store_no_lines(spark, folders, name):
    assert iq.query.__globals__["QUERIES"][name](spark, SF).count() > 0
    assert not folders


def test_stream_parts_are_written_by_all_tasks(spark, folders, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(str(tmp_path / "sf/events.parquet"))
    ones = [F.col("event_timestamp") < "2024-01-16", F.col("event_timestamp") >= "2024-01-16"]
    iq._sessions_of_parts(spark, str(tmp_path / "sf"), "1 hour", *ones)
    parts = Path(dict(folders)["parts"])
    assert [len(list((parts / f"part={n}").glob("*.parquet"))) for n in (0, 1)] == [3, 3]


def test_both_files_of_messages_hold_the_same_ids(spark, folders):
    iq.query.__globals__["QUERIES"]["I3_pipeline_messages"](spark, SF)
    folder = dict(folders)["messages"]
    assert list(Path(folder).glob("part=1/*.gz"))
    first, second = (spark.read.json(f"{folder}/part={n}").select("MessageId", "Body") for n in (1, 2))
    events = spark.read.parquet(f"{SF}/events.parquet").count()
    assert first.count() == second.count() == first.select("MessageId").distinct().count() == events
    assert first.exceptAll(second).isEmpty()


def test_ingest_stores_lines_once_before_staging(spark, monkeypatch, tmp_path):
    stored = {}

    def cut(wh, df, name, seq):
        stored[name] = df.columns
        return silver_cut(wh, df, name, seq)

    silver_cut = silver.cut
    monkeypatch.setattr(silver, "cut", cut)
    monkeypatch.setattr(jobs, "cut", cut)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    lines = iq.raw_lines(spark, SF).unionByName(spark.createDataFrame([("no json",)], "value string"))
    counts = jobs.ingest_batch(wh, lines, iq.OPTIONS, load="one")
    assert [n for n, columns in stored.items() if {"raw_event", "value"} & set(columns)] == ["flat"]
    assert counts["lines"] == lines.count() == counts["parsed_ok"] + counts["parse_dead"]
    letters = spark.read.json(wh.path("dead_letters")).filter("stage = 'parse'")
    assert letters.count() == counts["parse_dead"] and letters.filter("raw_event = 'no json'").count() == 1
    assert wh.table("stg_events").count() == counts["staged_rows"]
    assert wh.table("stg_events").filter("raw_event IS NULL").isEmpty()
