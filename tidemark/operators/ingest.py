"""Raw events to staged event x item rows, with routing of bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import ga4
from tidemark.functions.columns import ntz, pin
from tidemark.options import Options

_ITEM_FIELDS = (
    *ga4.TEXT_FIELDS, *ga4.NUMBER_FIELDS,
    "discount_value", "total_price", "installments", "installment_price", "discounts", "is_in_stock",
)
_ITEM_STRUCT = "struct<" + ",".join(f"{f}:string" for f in _ITEM_FIELDS) + ">"
_NUMBERS = {
    f.name: f.dataType.simpleString()
    for f in schemas.STG_EVENTS.fields
    if f.dataType.typeName() in ("decimal", "integer")
}


def micros_of(text: Column) -> Column:
    """Microseconds of a whole or decimal number; NULL for anything else, so the row becomes a dead letter."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"))


def micros_to_ntz(micros: Column) -> Column:
    """NULL for a time of over twelve digits of seconds, such as nanoseconds taken for microseconds."""
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).try_cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def item_texts(items: Column) -> Column:
    """Item texts of either form: the array text or a JSON list."""
    is_list = items.rlike(r'^\s*\[\s*\{\s*"')
    return F.when(is_list, F.from_json(items, "array<string>")).otherwise(ga4.split_items(items))


def explode_items(
    events: DataFrame, options: Options = Options(), seen: Observation | None = None, dead: str | None = None
) -> DataFrame:
    """One row per event and item with the parsed ``item``; events without items give no row.

    ``seen`` gets how many events carry no item. Rows that the column ``dead`` marks are no events and stay as they are.
    """
    rows = events.withColumn("item_text", F.explode_outer(item_texts(F.col("items"))))
    held = F.col("item_text").isNotNull()
    if dead:
        held = held | F.col(dead)
    if seen:
        rows = rows.observe(seen, F.count_if(~held).alias("events_without_items"))
    rows = rows.filter(held)
    parsed = ga4.parse_items(rows, "item_text", options.item_params).withColumnRenamed("item", "text_item")
    listed = F.when(
        F.col("item_text").rlike(r'^\s*\{\s*"'), F.from_json(F.col("item_text"), _ITEM_STRUCT)
    )
    from_text = F.struct(*[F.col(f"text_item.{f}").alias(f) for f in _ITEM_FIELDS])
    return pin(parsed, "item", F.coalesce(listed, from_text)).drop("text_item")


def _typed(name: str, kind: str) -> Column:
    text = F.col(f"item.{name}")
    if kind == "int":
        return text.try_cast("decimal(18,6)").try_cast("int")
    return text.try_cast(kind)


def flatten_events(
    events: DataFrame, run_ts, options: Options = Options(), seen: Observation | None = None, dead: str | None = None
) -> DataFrame:
    """One row per event and item; events without items give no row (``seen`` gets their number).

    ``cast_errors`` names the numeric fields whose text does not fit the column. With ``dead``, rows that this column
    marks stay too, and it and ``filepath`` are kept.
    """
    rows = explode_items(events.withColumn("micros", micros_of(F.col("event_timestamp"))), options, seen, dead)
    rows = pin(rows, "codes", ga4.split_discounts("item.discounts", options.experiment_pattern))
    stock = F.col("item.is_in_stock")
    columns = {
        "event_id": ga4.event_id("micros", "user_id", "event_name", "item.item_id"),
        "event_timestamp": micros_to_ntz(F.col("micros")),
        "replay_timestamp": F.col("replay_timestamp").try_cast("timestamp").cast("timestamp_ntz"),
        "item_list_id": F.col("item.item_list_id"),
        "item_list_name": F.col("item.item_list_name"),
        "product_id": F.col("item.item_id"),
        "product_name": F.col("item.item_name"),
        "discount_campaigns": F.col("codes.campaigns"),
        "discount_experiment_variant": F.col("codes.experiment_variant"),
        "is_in_stock": F.coalesce(stock.try_cast("boolean"), stock.try_cast("double") != 0),
        "ingestion_timestamp": ntz(run_ts),
        **{n: _typed(n, k) for n, k in _NUMBERS.items()},
    }
    out = [columns.get(n, F.col(n) if n in rows.columns else None).alias(n) for n in schemas.STG_EVENTS.names]
    typed = pin(rows, "row", F.struct(*out))
    errors = F.array_compact(
        F.array(
            *[
                F.when(F.col(f"item.{n}").isNotNull() & F.col(f"row.{n}").isNull(), F.lit(f"uncastable:{n}"))
                for n in _NUMBERS
            ]
        )
    )
    return typed.select("row.*", errors.alias("cast_errors"), *([dead, "filepath"] if dead else []))


def without_items(events: DataFrame) -> DataFrame:
    """How many events carry no item and therefore stage no row."""
    return events.agg(
        F.count_if(F.coalesce(F.size(item_texts(F.col("items"))), F.lit(0)) <= 0).alias("events_without_items")
    )


def validation_errors(required) -> Column:
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing_required:{c}")) for c in required]
    checks.append(F.when(F.col("event_timestamp").isNull(), F.lit("invalid:event_timestamp")))
    checks.append(F.when(F.coalesce("event_id", F.lit("")) == "", F.lit("invalid:event_id")))
    return F.array_compact(F.array(*checks))


def validate(df: DataFrame, required=Options().required_fields) -> tuple[DataFrame, DataFrame]:
    """Rows to stage, and dead letters of the validate and insert stages."""
    columns = schemas.STG_EVENTS.names
    casts = F.col("cast_errors") if "cast_errors" in df.columns else F.array().cast("array<string>")
    checked = pin(df.withColumn("casts", casts), "errors", validation_errors(required))
    clean = (F.size("errors") == 0) & (F.size("casts") == 0)
    good = checked.filter(clean).select(*columns)
    invalid = F.size("errors") > 0
    bad = checked.filter(~clean).select(
        F.when(invalid, F.lit("validate")).otherwise(F.lit("insert")).alias("stage"),
        F.concat_ws(",", F.when(invalid, F.col("errors")).otherwise(F.col("casts"))).alias("error"),
        F.lit(None).cast("string").alias("filepath"),
        F.to_json(F.struct(*columns)).alias("flat_record"),
        "raw_event",
    )
    return good, bad


def parse_metrics(parsed: DataFrame) -> DataFrame:
    """Counts of lines read, parsed and dead."""
    return parsed.agg(*_line_counts())


def observe_parse(parsed: DataFrame, name: str = "parse") -> tuple[DataFrame, Observation]:
    """The same counts collected while the frame is being written, without a pass of their own."""
    seen = Observation(name)
    return parsed.observe(seen, *_line_counts()), seen


def _line_counts() -> list:
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("event").isNotNull()).alias("parsed_ok"),
        F.count_if(F.col("event").isNull()).alias("parse_dead"),
    ]
