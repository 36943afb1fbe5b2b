"""Gap sessions of an event stream, by the same rule as the batch job.

Sessions that can still grow are kept as a table from one micro-batch to the next. The watermark is the greatest event
time of the batches before, less the allowed delay. A session is closed once it ended more than the gap before the
watermark; a row behind the watermark is late. So no row that is not late can reach a closed session: closed and open
sessions are exactly those of all rows that are not late, and late rows are kept as they came.

Folders under ``root``, one ``batch=N`` each: ``live`` sessions a batch worked on, ``closed`` ones it finished, ``late``
rows, and ``marks``, the watermark after it. A batch reads what batch N - 1 wrote and replaces what an earlier attempt of
its own left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ntz
from tidemark.operators.sessions import ACTOR, COUNTS, event_counts, session_cells, sessionizable
from tidemark.sources.files import delete, file_system
from tidemark.streaming.jobs import drain

STREAMED = [*ACTOR, "session_start_ts", "session_end_ts", *COUNTS]
_SCHEMA = (
    "user_id string, platform_id int, session_start_ts timestamp_ntz, session_end_ts timestamp_ntz, "
    "events_in_session long, views long, checkouts long, purchases long"
)
_MARK = "high timestamp_ntz, watermark timestamp_ntz"


def _final(watermark, minutes: int) -> Column:
    """Whether nothing that is not late can reach the session any more."""
    if watermark is None:
        return F.lit(False)
    return F.col("session_end_ts") + F.expr(f"interval {minutes} minutes") < ntz(watermark)


def grow_sessions(live: DataFrame, rows: DataFrame, minutes: int) -> DataFrame:
    """Live sessions and the cells of new rows joined into sessions; intervals on one line per actor, no pairing."""
    cells = session_cells(rows, minutes, *event_counts()).select(
        *ACTOR, F.col("cell_start").alias("lo"), F.col("cell_end").alias("hi"), *COUNTS
    )
    old = live.select(*ACTOR, F.col("session_start_ts").alias("lo"), F.col("session_end_ts").alias("hi"), *COUNTS)
    order = Window.partitionBy(*ACTOR).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = reach.isNull() | (F.col("lo") - reach > F.expr(f"interval {minutes} minutes"))
    whole = old.unionByName(cells).withColumn("opened", F.when(opens, F.col("lo")))
    whole = whole.withColumn(
        "session_start_ts",
        F.last("opened", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    )
    return whole.groupBy(*ACTOR, "session_start_ts").agg(
        F.max("hi").alias("session_end_ts"), *[F.sum(c).alias(c) for c in COUNTS]
    ).select(*STREAMED)


def _session_batch(root: str, minutes: int, delay: str, rows: DataFrame, n: int) -> None:
    spark = rows.sparkSession

    def path(name: str, batch: int = n) -> str:
        return f"{root}/{name}/batch={batch}"

    mark = spark.read.schema(_MARK).parquet(path("marks", n - 1)).first() if n else None
    on_time = sessionizable(rows)
    live = spark.createDataFrame([], _SCHEMA)
    if mark:
        live = spark.read.schema(_SCHEMA).parquet(path("live", n - 1)).filter(~_final(mark["watermark"], minutes))
    if mark and mark["watermark"]:
        behind = F.col("event_timestamp") < ntz(mark["watermark"])
        on_time.filter(behind).write.mode("overwrite").parquet(path("late"))
        on_time = on_time.filter(~behind)
    grow_sessions(live, on_time, minutes).write.mode("overwrite").parquet(path("live"))
    sessions = spark.read.schema(_SCHEMA).parquet(path("live"))
    # The latest row on time ends a live session.
    high = sessions.agg(F.max("session_end_ts")).first()[0]
    high = ntz(max((h for h in (high, mark and mark["high"]) if h), default=None))
    made = spark.range(1).select(high.alias("high"), (high - F.expr(f"interval {delay}")).alias("watermark"))
    sessions.filter(_final(made.first()["watermark"], minutes)).write.mode("overwrite").parquet(path("closed"))
    made.write.mode("overwrite").parquet(path("marks"))
    if n > 1:
        delete(spark, path("live", n - 2))


def sessionize_stream(
    stream: DataFrame, root: str, checkpoint: str, minutes: int = 30, delay: str = "1 hour"
) -> None:
    """Drain the stream into session tables under ``root`` (see ``closed_sessions``, ``open_sessions``, ``late_rows``).

    Rows need a user, a platform and a time; others have no session. A busy user's events arrive at the window as
    cells of at most one gap, however many they are.
    """
    drain(stream, lambda rows, n: _session_batch(root, minutes, delay, rows, n), checkpoint)


def _batches(spark: SparkSession, root: str, name: str) -> list[int]:
    fs, p = file_system(spark, f"{root}/{name}")
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if "=" in s.getPath().getName())


def _finished(spark: SparkSession, root: str) -> int:
    """The last batch that wrote its mark, -1 before the first."""
    return max(_batches(spark, root, "marks"), default=-1)


def closed_sessions(spark: SparkSession, root: str) -> DataFrame:
    last = _finished(spark, root)
    paths = [f"{root}/closed/batch={n}" for n in _batches(spark, root, "closed") if n <= last]
    return spark.read.schema(_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], _SCHEMA)


def open_sessions(spark: SparkSession, root: str, minutes: int = 30) -> DataFrame:
    """Sessions that may still grow; with the closed ones, all sessions of all rows that were not late."""
    last = _finished(spark, root)
    if last < 0:
        return spark.createDataFrame([], _SCHEMA)
    mark = spark.read.schema(_MARK).parquet(f"{root}/marks/batch={last}").first()
    return spark.read.schema(_SCHEMA).parquet(f"{root}/live/batch={last}").filter(~_final(mark["watermark"], minutes))


def late_rows(spark: SparkSession, root: str, schema) -> DataFrame:
    """Rows that came behind the watermark, whole."""
    last = _finished(spark, root)
    paths = [f"{root}/late/batch={n}" for n in _batches(spark, root, "late") if n <= last]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
