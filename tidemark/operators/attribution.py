"""Last-touch attribution inside sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import codes, is_event
from tidemark.operators import asof
from tidemark.operators.sessions import (
    ACTOR,
    IMPRESSION,
    SESSION,
    campaign_mark,
    name_sessions,
    session_islands,
    sessionizable,
    with_cell,
)

ACTIONABLE = ("view_item", "begin_checkout", "purchase")
MODEL = "last_touch_session"


def actionable(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_name").isin(*ACTIONABLE) & F.col("user_id").isNotNull())


def impression_mark():
    """(time, event, list) of a list view; the greatest one at or before an event is its last touch."""
    return F.when(
        is_event(IMPRESSION) & F.col("item_list_id").isNotNull(),
        F.struct(
            F.col("event_timestamp").alias("ts"),
            F.col("event_id").alias("event_id"),
            F.col("item_list_id").alias("item_list_id"),
        ),
    )


def last_touch(facts: DataFrame, minutes: int = 30) -> DataFrame:
    """Actionable events with session, ``item_list_id`` (NULL if none) and ``impression_ts_chosen``.

    The session cells double as as-of buckets: one pass over the distinct times of the facts finds session starts and
    carries the last list view from cell to cell; then the actionable rows alone move, to their time. A list view at or
    after the session start belongs to the session.
    """
    rows = with_cell(sessionizable(facts), minutes).withColumnRenamed("cell", "bucket")
    times = asof.points(rows.withColumn("mark", impression_mark()), ACTOR, "event_timestamp")
    ends = F.min("event_timestamp").alias("cell_start"), F.max("event_timestamp").alias("cell_end")
    cells = asof.buckets(times, ACTOR, *ends).withColumnRenamed("bucket", "cell")
    islands = session_islands(cells, minutes).withColumnRenamed("cell", "bucket")
    latest_of = asof.resolved(
        times, asof.with_carry(islands, ACTOR), ACTOR, "event_timestamp", keep=["session_start_ts"]
    )
    found = actionable(rows).drop("item_list_id").join(latest_of, [*ACTOR, "bucket", "event_timestamp"])
    in_session = F.col("latest.ts") >= F.col("session_start_ts")
    return name_sessions(
        found.withColumn("item_list_id", F.when(in_session, F.col("latest.item_list_id")))
        .withColumn("impression_ts_chosen", F.when(in_session, F.col("latest.ts")))
        .drop("bucket", "latest")
    )


def list_attribution(touched: DataFrame, minutes: int = 30) -> DataFrame:
    """The stored record of every attributed event."""
    return touched.filter(F.col("item_list_id").isNotNull()).select(
        "event_id",
        "user_id",
        "event_name",
        "event_timestamp",
        "item_list_id",
        "platform_id",
        "session_id",
        "session_start_ts",
        "impression_ts_chosen",
        F.lit(MODEL).alias("attribution_model"),
        F.lit(minutes).alias("window_minutes"),
        F.lit(1).alias("attribution_version"),
        F.to_date("event_timestamp").alias("date_id"),
        "item_revenue_in_usd",
        "installments",
        "session_date",
    )


def campaign_last_touch(sessionized: DataFrame) -> DataFrame:
    """Last campaign of every session, from labelled events."""
    touched = sessionized.filter(F.size(codes("campaign_codes")) > 0)
    return _touch_record(touched.groupBy(*SESSION).agg(F.max(campaign_mark()).alias("touch")))


def rollup_campaign_touch(rollup: DataFrame) -> DataFrame:
    """The same from the one-pass session rollup."""
    return _touch_record(rollup.filter(F.col("touch").isNotNull()))


def _touch_record(df: DataFrame) -> DataFrame:
    return name_sessions(
        df.select(
            *SESSION,
            F.col("touch.campaign_id").alias("campaign_id"),
            F.col("touch.ts").alias("last_touch_ts"),
        )
    )
