"""Fill new columns of staged rows from the raw event they came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ga4
from tidemark.functions.columns import pin
from tidemark.operators.ingest import item_texts
from tidemark.options import BACKFILL_FIELDS, DEFAULT_BACKFILL


def _fields(fields) -> dict:
    unknown = [f for f in fields if f not in BACKFILL_FIELDS]
    if unknown:
        raise ValueError(f"unknown backfill fields: {unknown}")
    return {f: BACKFILL_FIELDS[f] for f in fields}


def item_of_row(item_index: int | None) -> Column:
    """The row's own item by product id, or the item at a fixed position; items come as text or as a JSON list."""
    items = item_texts(F.get_json_object("raw_event", "$.items"))
    if item_index is not None:
        return F.try_element_at(items, F.lit(item_index + 1))
    own = F.filter(items, lambda i: ga4.item_field(i, "item_id").eqNullSafe(F.col("product_id")))
    return F.try_element_at(own, F.lit(1))


def _with_found(df: DataFrame, fields: dict, item_index) -> DataFrame:
    missing = {f: F.lit(None).cast("string") for f in fields if f not in df.columns}
    items = pin(df.withColumns(missing), "item_text", item_of_row(item_index))
    return pin(
        items, "found", F.struct(*[ga4.item_field("item_text", key).alias(f) for f, key in fields.items()])
    )


def backfill(
    df: DataFrame, fields=DEFAULT_BACKFILL, dry_run: bool = False, item_index: int | None = None
) -> DataFrame:
    """``df`` with NULL targets filled; a dry run returns the statistics instead."""
    if dry_run:
        return backfill_stats(df, fields, item_index)
    names = _fields(fields)
    filled = _with_found(df, names, item_index)
    return filled.withColumns({f: F.coalesce(f, f"found.{f}") for f in names}).drop("item_text", "found")


def backfill_stats(df: DataFrame, fields=DEFAULT_BACKFILL, item_index: int | None = None) -> DataFrame:
    """Per field: rows with a NULL target and rows for which a value was found."""
    names = _fields(fields)
    filled = _with_found(df, names, item_index)
    any_null = F.lit(False)
    for f in names:
        any_null = any_null | F.col(f).isNull()
    counts = filled.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(any_null).alias("rows_needing_backfill"),
        *[F.count_if(F.col(f).isNull()).alias(f"null_{f}") for f in names],
        *[F.count_if(F.col(f).isNull() & F.col(f"found.{f}").isNotNull()).alias(f"got_{f}") for f in names],
    )
    per_field = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"null_{f}").alias("null_rows"),
                F.col(f"got_{f}").alias("values_found"),
            )
            for f in names
        ]
    )
    return counts.select("total_rows", "rows_needing_backfill", F.inline(per_field))
