"""Backfill of staged rows as a job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators.backfill import backfill, backfill_stats
from tidemark.options import DEFAULT_BACKFILL
from tidemark.plans.silver import cut, days_of
from tidemark.sources.warehouse import Warehouse, replace_partitions

PARTITION = ["ingestion_date", "load"]


def staged(wh: Warehouse, fields=DEFAULT_BACKFILL, dates: list | None = None) -> DataFrame:
    """Staging with the backfill columns (NULL where a file does not have them yet) and where each row lies."""
    extra = [T.StructField(f, T.StringType()) for f in fields if f not in schemas.STG_EVENTS.names]
    wide = T.StructType([*schemas.STG_EVENTS.fields, *extra])
    return wh.table("stg_events", dates=dates, schema=wide)


def run_backfill(
    wh: Warehouse, fields=DEFAULT_BACKFILL, dates: list | None = None, item_index: int | None = None,
    dry_run: bool = False,
) -> dict | DataFrame:
    """Fill NULL columns of staged rows from their raw events; a dry run returns the statistics instead.

    Only ingestion dates on which a value is found are rewritten, each load in place; running it again, or after it
    died, changes nothing more. Items may come as text or as a JSON list. Returns the dates and the number of rows filled.
    """
    rows = staged(wh, fields, dates)
    if dry_run:
        return backfill_stats(rows, fields, item_index)
    before = F.struct(*[F.col(f) for f in fields])
    filled = backfill(rows.withColumn("before", before), fields, item_index=item_index)
    changed = ~F.col("before").eqNullSafe(F.struct(*[F.col(f) for f in fields]))
    work = cut(wh, filled.withColumn("filled", changed).drop("before"), "backfill", wh.committed())
    found = work.filter("filled")
    touched = days_of(found.select("ingestion_date"))
    n = found.count()
    if touched:
        # The rows of these dates are written from the copy, so no file is read and replaced at once.
        replace_partitions(work.filter(F.col("ingestion_date").isin(touched)).drop("filled"), wh.path("stg_events"), PARTITION)
    return {"dates": sorted(touched), "rows_filled": n}
