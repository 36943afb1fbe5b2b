"""Event fact and the small aggregate facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import date_key, is_event, ntz
from tidemark.operators.scd import END, START, as_of_join, campaign_rows, conform
from tidemark.sources.lookups import resolve_platform

PURCHASE_COLUMNS = [
    "event_id", "user_id", "platform_id", "product_id", "item_list_id", "item_revenue", "installments",
    "installment_price", "total_price", "price", "discount_value", "quantity", "event_timestamp",
]


def fct_events(net_new: DataFrame, platforms: DataFrame, run_ts) -> DataFrame:
    """Immutable event grain; ``run_ts`` stamps both audit columns."""
    stamp = ntz(run_ts)
    rows = (
        resolve_platform(net_new, platforms)
        .withColumn("date_id", F.to_date("event_timestamp"))
        .withColumnRenamed("discount_campaigns", "campaign_codes")
        .withColumnRenamed("discount_experiment_variant", "experiment_id")
        .withColumn("ingestion_timestamp", stamp)
        .withColumn("updated_at", stamp)
    )
    return conform(rows, schemas.FCT_EVENTS)


def _measures() -> list:
    revenue = F.when(is_event("purchase"), F.col("item_revenue")).otherwise(0)
    return [
        F.count_if(is_event("view_item")).alias("views"),
        F.count_if(is_event("begin_checkout")).alias("checkouts"),
        F.count_if(is_event("purchase")).alias("purchases"),
        F.sum(revenue).cast("decimal(18,2)").alias("revenue"),
    ]


def product_daily(net_new: DataFrame) -> DataFrame:
    return (
        net_new.filter(F.col("product_id").isNotNull())
        .groupBy(date_key("event_timestamp").alias("date_id"), "product_id")
        .agg(*_measures())
        .select(*schemas.PRODUCT_DAILY.names)
    )


def product_campaign_days(net_new: DataFrame, distinct_codes: bool = False) -> DataFrame:
    """Additive counters per product, campaign, day and discount.

    Events collapse to (product, code list, day, discount) before codes are exploded. A code listed twice in one event
    counts twice unless ``distinct_codes``.
    """
    day_level = (
        net_new.filter(
            F.col("product_id").isNotNull()
            & F.col("discount_campaigns").isNotNull()
            & (F.col("discount_campaigns") != "")
        )
        .groupBy(
            "product_id",
            "discount_campaigns",
            F.to_date("event_timestamp").alias("day"),
            F.coalesce("discount_value", F.lit(0)).cast("decimal(10,2)").alias("discount_value"),
        )
        .agg(F.count(F.lit(1)).alias("total_events"), *_measures())
    )
    if distinct_codes:
        day_level = day_level.withColumn(
            "discount_campaigns",
            F.array_join(F.array_distinct(F.split("discount_campaigns", r"\|")), "|"),
        )
    keys = ["product_id", "campaign_id", "day", "discount_value"]
    counters = ["total_events", "views", "checkouts", "purchases"]
    return campaign_rows(day_level).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in counters], F.sum("revenue").cast("decimal(18,2)").alias("revenue")
    ).select(*schemas.PRODUCT_CAMPAIGN_DAYS.names)


def priced_campaigns(days: DataFrame, dim_campaigns: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Product x campaign x version price x discount counters of ``product_campaign_days`` rows.

    The price is that of the version valid on the day, as the dimensions know it now, so late events and late
    snapshots give what one run over everything gives.
    """
    validity = [START, END]
    in_campaign = as_of_join(days, dim_campaigns.select("campaign_id", *validity), "campaign_id", "day").drop(*validity)
    priced = as_of_join(in_campaign, dim_products.select("product_id", "price", *validity), "product_id", "day")
    counters = ["total_events", "views", "checkouts", "purchases"]
    return (
        priced.groupBy("product_id", "campaign_id", "price", "discount_value")
        .agg(
            *[F.sum(c).alias(c) for c in counters],
            F.sum("revenue").cast("decimal(18,2)").alias("revenue"),
            F.min("day").alias("first_seen_date"),
            F.max("day").alias("last_seen_date"),
        )
        .select(*schemas.PRODUCT_CAMPAIGNS.names)
    )


def product_campaigns(
    net_new: DataFrame, dim_campaigns: DataFrame, dim_products: DataFrame, distinct_codes: bool = False
) -> DataFrame:
    """``priced_campaigns`` of the days of ``net_new``."""
    return priced_campaigns(product_campaign_days(net_new, distinct_codes), dim_campaigns, dim_products)


def purchases(facts: DataFrame) -> DataFrame:
    return facts.filter(is_event("purchase")).select(
        *PURCHASE_COLUMNS, F.to_date("event_timestamp").alias("event_date")
    )
