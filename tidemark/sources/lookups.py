"""Calendar and platform lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.options import PLATFORMS


def dim_dates(spark: SparkSession, start, end) -> DataFrame:
    """One row per day of [start, end]."""
    span = spark.range(1).select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))
    return calendar(span)


def calendar(span: DataFrame) -> DataFrame:
    """One row per day between the columns ``lo`` and ``hi`` of a one-row frame."""
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_key"))
    weekday = F.dayofweek("date_key") - 1
    return days.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.dayofmonth("date_key").alias("day"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.date_format("date_key", "MMMM").alias("month_name"),
        F.quarter("date_key").alias("quarter"),
    )


def dim_platforms(spark: SparkSession, rows=PLATFORMS) -> DataFrame:
    return spark.createDataFrame(list(rows), "platform_id int, platform_name string")


def resolve_platform(df: DataFrame, platforms: DataFrame) -> DataFrame:
    """Adds ``platform_id``; unknown names give NULL. The lookup holds a handful of seeded rows."""
    names = platforms.select("platform_id", F.col("platform_name").alias("resolved_name"))
    return df.join(
        F.broadcast(names), F.upper("platform") == F.col("resolved_name"), "left"
    ).drop("resolved_name")
