"""Which staged rows belong to this run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import ntz
from tidemark.operators.upsert import newest_per_key

PIPELINE = "silver_events"


@dataclass(frozen=True)
class Bounds:
    """Half-open range ((last_ts, last_id), (upper_ts, upper_id)] of (ingestion time, event id)."""

    last_ts: datetime | None = None
    last_id: str | None = None
    upper_ts: datetime | None = None
    upper_id: str | None = None

    @property
    def empty(self) -> bool:
        return self.upper_ts is None


def hwm_bounds(stg: DataFrame, checkpoint: DataFrame | None = None) -> DataFrame:
    """One row: last high-water mark and the upper bound of this run."""
    upper = stg.agg(F.max(F.struct("ingestion_timestamp", "event_id")).alias("upper")).select(
        F.col("upper.ingestion_timestamp").alias("upper_ts"), F.col("upper.event_id").alias("upper_id")
    )
    if checkpoint is None:
        last = [None, None]
    else:
        row = checkpoint.filter(F.col("pipeline") == PIPELINE).first()
        last = [row["hwm_ts"], row["hwm_event_id"]] if row else [None, None]
    return upper.select(
        ntz(last[0]).alias("last_ts"),
        F.lit(last[1]).cast("string").alias("last_id"),
        "upper_ts",
        "upper_id",
    )


def fetch_bounds(bounds: DataFrame) -> Bounds:
    """The one-row bounds as literals, so that the range reaches the scan as pushed filters."""
    return Bounds(**bounds.first().asDict())


def current_batch(stg: DataFrame, bounds: Bounds) -> DataFrame:
    """Rows strictly after the last mark, up to the captured upper bound."""
    if bounds.empty:
        return stg.limit(0)
    ts, eid = F.col("ingestion_timestamp"), F.col("event_id")
    upper = ntz(bounds.upper_ts)
    keep = (ts <= upper) & ((ts < upper) | (eid <= F.lit(bounds.upper_id)))
    if bounds.last_ts is not None:
        last = ntz(bounds.last_ts)
        keep = keep & (ts >= last) & ((ts > last) | (eid > F.lit(bounds.last_id)))
    return stg.filter(keep)


def dedup_latest(df: DataFrame, key: str = "event_id", order: tuple = ("ingestion_timestamp",)) -> DataFrame:
    """The row with the greatest ``order`` per key; remaining ties go by all columns.

    An aggregate rather than a ranking window, so copies of one key collapse map-side.
    """
    return newest_per_key(df, [key], list(order))


def net_new(batch: DataFrame, facts: DataFrame, days: list | None = None) -> DataFrame:
    """Batch rows whose event is not in the facts yet.

    An event id covers the event time, so copies share the date: only fact partitions of the batch's dates are read.
    ``days`` names them; otherwise they are found from the batch (at most one row per calendar day is broadcast).
    """
    known = facts.select("event_id", "date_id")
    if days is None:
        dates = batch.select(F.to_date("event_timestamp").alias("date_id")).distinct()
        known = known.join(F.broadcast(dates), "date_id", "left_semi")
    else:
        known = known.filter(F.col("date_id").isin(days))
    return batch.join(known.select("event_id"), "event_id", "left_anti")


def batch_counts(batch: DataFrame, new: DataFrame) -> DataFrame:
    tagged = batch.select(F.lit(1).alias("b"), F.lit(0).alias("n")).unionAll(
        new.select(F.lit(0).alias("b"), F.lit(1).alias("n"))
    )
    return tagged.agg(
        F.coalesce(F.sum("b"), F.lit(0)).cast("long").alias("current_batch_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("net_new_rows"),
    )


def advance(
    spark: SparkSession, bounds: Bounds, batch_rows: int, new_rows: int, run_ts, max_session_days: int = 0
) -> DataFrame:
    """The next checkpoint row; an empty run keeps the old mark.

    ``max_session_days`` is the most days any stored session spans. It bounds how far back a run has to
    look for sessions its batch may reach.
    """
    ts = bounds.last_ts if bounds.empty else bounds.upper_ts
    eid = bounds.last_id if bounds.empty else bounds.upper_id
    return spark.createDataFrame(
        [(PIPELINE, ts, eid, batch_rows, new_rows, run_ts, max_session_days)], schemas.CHECKPOINTS
    )
