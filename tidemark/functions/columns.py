"""Small column helpers shared by the operators."""

from __future__ import annotations

from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def session_key(user, platform_id, start) -> Column:
    """``user:platform:start``, the text key of a session."""
    return F.concat(
        col(user), F.lit(":"), col(platform_id).cast("string"), F.lit(":"), col(start).cast("string")
    )


def date_key(ts) -> Column:
    """yyyymmdd as an integer."""
    c = col(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def rate(num, den) -> Column:
    """num / den as double, NULL where the denominator is zero or NULL."""
    return F.when(col(den) != 0, col(num).cast("double") / col(den).cast("double"))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp, whatever the session time zone."""
    c = col(ts)
    return (
        F.unix_date(F.to_date(c)).cast("long") * 86400
        + F.hour(c) * 3600
        + F.minute(c) * 60
        + F.floor(F.date_part(F.lit("second"), c)).cast("int")
    )


def time_bucket(ts, seconds: int) -> Column:
    return F.floor(epoch_seconds(ts) / F.lit(seconds)).cast("long")


def pin(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    The optimizer copies a plain column's expression into every later use of it, which multiplies long
    regular-expression chains; it does not look through a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def codes(c) -> Column:
    """Non-empty codes of a pipe-joined list."""
    return F.filter(F.split(col(c), r"\|"), lambda x: x != "")


def is_event(name: str) -> Column:
    return F.col("event_name") == name


def surrogate(*cols) -> Column:
    return F.xxhash64(*[col(c) for c in cols])


def ntz(value) -> Column:
    """A datetime (or its text) as a zone-less timestamp literal, whatever the local time zone."""
    text = value if value is None or isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def observed(seen: Observation, *names: str) -> dict:
    """Counts that a finished write observed.

    A part of the plan that Spark proved to be empty is dropped together with its counts; they are 0 then.
    """
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return dict.fromkeys(names, 0)
