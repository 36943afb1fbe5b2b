"""Raw event lines: batch and streaming readers, and the two append sinks of the ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import pin
from tidemark.sources.files import delete_matching

EVENT_FIELDS = (
    "event_timestamp", "user_id", "event_name", "platform", "replay_timestamp", "items",
)
_PARSED = "struct<" + ",".join(f"{f}:string" for f in EVENT_FIELDS) + ",_bad:string>"
_JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines (``value``) with the parsed event; ``event`` is NULL for a line that is no JSON object."""
    ok = F.col("value").rlike(r"^\s*\{") & F.col("parsed").isNotNull() & F.col("parsed._bad").isNull()
    parsed = pin(lines, "parsed", F.from_json("value", _PARSED, _JSON))
    return parsed.withColumn("event", F.when(ok, F.col("parsed").dropFields("_bad"))).drop("parsed")


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = parsed.filter(F.col("event").isNotNull()).select("event.*", F.col("value").alias("raw_event"))
    source = F.col("filepath") if "filepath" in parsed.columns else F.lit(None).cast("string")
    dead = parsed.filter(F.col("event").isNull()).select(source.alias("filepath"), F.col("value").alias("raw_event"))
    return good, parse_letters(dead)


def parse_letters(dead: DataFrame) -> DataFrame:
    """Dead letters of lines (``raw_event``, ``filepath``) that are no JSON object."""
    return dead.select(
        F.lit("parse").alias("stage"),
        F.lit("invalid_json").alias("error"),
        "filepath",
        F.lit(None).cast("string").alias("flat_record"),
        F.trim("raw_event").alias("raw_event"),
    )


def with_dead(parsed: DataFrame) -> DataFrame:
    """Events, and lines that are none marked by ``dead``, in one frame."""
    source = F.col("filepath") if "filepath" in parsed.columns else F.lit(None).cast("string")
    return parsed.select(
        "event.*", F.col("value").alias("raw_event"), F.col("event").isNull().alias("dead"), source.alias("filepath")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("filepath"))


def read_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Events and dead lines of newline-delimited JSON files."""
    return split_parsed(parse_lines(read_lines(spark, path)))


def stream_events(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Raw lines of files as they arrive; every file is one immutable batch piece."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("filepath"))
    )


def stream_messages(
    spark: SparkSession, path: str, id_field: str = "MessageId", body_field: str = "Body", max_files: int = 100
) -> DataFrame:
    """Lines of files of JSON envelopes: ``message_id`` and the event line in ``value``.

    A line that is no envelope with both fields is passed on as it is under an id of its own, so it becomes a dead
    letter instead of getting lost.
    """
    lines = stream_events(spark, path, max_files)
    envelope = F.from_json("value", f"`{id_field}` string, `{body_field}` string")
    parsed = pin(lines, "envelope", envelope)
    whole = F.col(f"envelope.{id_field}").isNotNull() & F.col(f"envelope.{body_field}").isNotNull()
    return parsed.select(
        F.when(whole, F.col(f"envelope.{id_field}")).otherwise(F.expr("uuid()")).alias("message_id"),
        F.when(whole, F.col(f"envelope.{body_field}")).otherwise(F.col("value")).alias("value"),
        "filepath",
    )


def event_counts(events: DataFrame) -> DataFrame:
    name = F.coalesce("event_name", F.lit("unknown_event"))
    return events.groupBy(name.alias("event_name")).agg(F.count(F.lit(1)).alias("events"))


def append_staging(df: DataFrame, path: str, load: str | None = None) -> None:
    """Append in the fixed column order, by ingestion date so that a run reads only new days.

    Rows written under a ``load`` name replace those that an earlier attempt left under it, on whatever date.
    """
    if load:
        delete_matching(df.sparkSession, f"{path}/ingestion_date=*/load={load}")
    (
        df.select(
            *schemas.STG_EVENTS.names,
            F.to_date("ingestion_timestamp").alias("ingestion_date"),
            F.lit(load or uuid.uuid4().hex).alias("load"),
        )
        .write.mode("append")
        .partitionBy("ingestion_date", "load")
        .parquet(path)
    )


def write_dead_letters(df: DataFrame, path: str, load: str | None = None) -> None:
    """Append letters; those of one ``load`` name replace each other."""
    df.write.mode("overwrite").json(f"{path}/load={load or uuid.uuid4().hex}")
