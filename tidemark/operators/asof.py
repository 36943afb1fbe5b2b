"""As-of lookup that stays balanced when one key holds a large share of the rows.

Rows carry a nullable ``mark`` (a struct whose first field is the time of the mark). For every row we want the greatest
mark of the same group with time <= the row's time; equal times count. Time is cut into buckets, and there is one path
for all rows, however they are distributed:

1. ``points``: rows collapse map-side to one per (group, bucket, distinct time) with its greatest mark.
2. ``buckets``: points collapse to buckets; a window over a group's buckets (bounded by the time span over the bucket
   width) carries the greatest mark of all earlier buckets on.
3. ``resolved``: a running maximum over the distinct times of one bucket, on top of what was carried. It keeps one mark
   and streams over points that are sorted on disk, so its memory does not grow with the bucket.
4. Rows meet the points on equality of (group, bucket, time), which spreads any group and any bucket over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import time_bucket


def points(rows: DataFrame, by: list, ts: str) -> DataFrame:
    """One row per distinct time with its greatest mark."""
    return rows.groupBy(*by, "bucket", ts).agg(F.max("mark").alias("point_mark"))


def buckets(found: DataFrame, by: list, *extra) -> DataFrame:
    return found.groupBy(*by, "bucket").agg(F.max("point_mark").alias("bucket_mark"), *extra)


def with_carry(found: DataFrame, by: list) -> DataFrame:
    """Buckets with ``carry``, the greatest mark of all earlier ones of the group."""
    earlier = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("carry", F.max("bucket_mark").over(earlier))


def resolved(found: DataFrame, carried: DataFrame, by: list, ts: str, keep=()) -> DataFrame:
    """Points with ``latest``, the greatest mark up to their time, and the ``keep`` columns of their bucket."""
    keys = [*by, "bucket"]
    upto = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    latest = F.coalesce(F.max("point_mark").over(upto), F.col("carry"))
    known = found.join(carried.select(*keys, "carry", *keep), keys)
    return known.withColumn("latest", latest).select(*keys, ts, *keep, "latest")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: list,
    direction: str = "backward",
    tolerance: str | None = None,
    tiebreak: tuple = (),
    bucket_seconds: int = 86400,
) -> DataFrame:
    """Left rows with the nearest right row of the same ``by`` keys at or before (after) ``on``.

    Right columns come back as one struct ``matched`` (NULL without a match) whose field ``matched_on``
    is the time of the match. ``tolerance`` is an interval text such as ``"30 minutes"``. Keys that are
    NULL match nothing.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction: {direction}")
    payload = [c for c in right.columns if c not in (on, *by, *tiebreak)]
    # The forward join is the backward join on mirrored time.
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    clock = F.col(on) if direction == "backward" else origin - (F.col(on) - origin)
    present = F.col(on).isNotNull()
    for k in by:
        present = present & F.col(k).isNotNull()
    mark = F.struct(clock.alias("clock"), *[F.col(c) for c in (*tiebreak, *payload)], F.col(on).alias("matched_on"))
    bucket = time_bucket("clock", bucket_seconds).alias("bucket")
    probes = left.select(*by, clock.alias("clock"), F.struct(*left.columns).alias("row")).select("*", bucket)
    marks = right.filter(present).select(*by, clock.alias("clock"), mark.alias("mark")).select("*", bucket)
    asked = left.filter(present).select(*by, clock.alias("clock"), F.lit(None).alias("mark")).select("*", bucket)
    found = points(marks.unionByName(asked), by, "clock")
    latest_of = resolved(found, with_carry(buckets(found, by), by), by, "clock")
    joined = probes.join(latest_of, [*by, "bucket", "clock"], "left")
    latest = F.col("latest").dropFields("clock")
    if tolerance:
        distance = F.col(f"row.{on}") - F.col("latest.matched_on")
        if direction == "forward":
            distance = -distance
        latest = F.when(distance <= F.expr(f"interval {tolerance}"), latest)
    return joined.select("row.*", latest.alias("matched"))
