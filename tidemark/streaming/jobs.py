"""Structured Streaming jobs.

What a micro-batch writes is named after the stream and the batch, so a batch that is played again after a failure
replaces what its first attempt left behind.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.columns import observed, utc_now
from tidemark.operators import ingest
from tidemark.options import Options
from tidemark.plans.silver import cut, run_silver
from tidemark.sources.events import append_staging, parse_letters, parse_lines, with_dead, write_dead_letters
from tidemark.sources.warehouse import Warehouse


def dedup_messages(stream: DataFrame, id_col: str, ttl: str = "14 days") -> DataFrame:
    """First arrival of each message id; ids are forgotten ``ttl`` after they arrived.

    The watermark runs on the time of the micro-batch, not on the message's own, so a first arrival is never late.
    """
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", ttl)
    return arrived.dropDuplicatesWithinWatermark([id_col]).drop("_arrived")


def write_available(df: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over everything available now into parquet files, then stop."""
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain(stream: DataFrame, step, checkpoint: str) -> None:
    """Call ``step(batch, batch_id)`` for every micro-batch until the input is drained."""
    query = (
        stream.writeStream.foreachBatch(lambda df, n: step(df, n) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_id(spark, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def ingest_batch(
    wh: Warehouse,
    lines: DataFrame,
    options: Options = Options(),
    run_ts: datetime | None = None,
    load: str | None = None,
) -> dict:
    """Lines of one micro-batch to staging, dead letters and silver; returns every count of the way.

    The lines are read and parsed once, and stored once on the way to staging. ``load`` names the batch: a second attempt under the same name leaves staging
    and dead letters as one would, and its rows are no net-new facts if the first one committed them. A batch without
    lines starts no run.
    """
    run_ts = run_ts or utc_now()
    seq = wh.committed() + 1
    parsed, lines_seen = ingest.observe_parse(parse_lines(lines))
    items_seen, good_seen, bad_seen = Observation("items"), Observation("good"), Observation("bad")
    flat = cut(wh, ingest.flatten_events(with_dead(parsed), run_ts, options, items_seen, "dead"), "flat", seq)
    counts = observed(lines_seen, "lines", "parsed_ok", "parse_dead")
    if not counts["lines"]:
        return counts
    dead = parse_letters(flat.filter("dead"))
    good, bad = ingest.validate(flat.filter("NOT dead"), options.required_fields)
    rows = F.count(F.lit(1))
    append_staging(good.observe(good_seen, rows.alias("staged_rows")), wh.path("stg_events"), load)
    letters = dead.unionByName(bad.observe(bad_seen, rows.alias("invalid_rows")))
    write_dead_letters(letters, wh.path("dead_letters"), load)
    counts |= observed(items_seen, "events_without_items")
    counts |= observed(good_seen, "staged_rows") | observed(bad_seen, "invalid_rows")
    return {**counts, **run_silver(wh, options, batch=good, run_ts=run_ts)}


def run_pipeline_stream(
    wh: Warehouse, lines: DataFrame, checkpoint: str, options: Options = Options(), id_col: str | None = None
) -> list[dict]:
    """Raw line stream to silver, one silver run per micro-batch, until the input is drained; the counts of each run.

    With ``id_col`` a message whose id arrived within ``options.message_ttl`` is dropped before it is staged, across
    restarts of the stream.
    """
    if id_col:
        lines = dedup_messages(lines, id_col, options.message_ttl)
    counts: list[dict] = []

    def step(df: DataFrame, n: int) -> None:
        counts.append(ingest_batch(wh, df, options, load=f"{stream_id(wh.spark, checkpoint)}-{n}"))

    drain(lines, step, checkpoint)
    return counts
