"""Metric sets the business questions name; the definitions are ours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import codes, is_event, rate
from tidemark.operators.sessions import ACTOR, SESSION


def _count(c: str):
    return F.count_if(F.col(c))


def platform_daily(features: DataFrame, purchases: DataFrame) -> DataFrame:
    """Sessions, funnel and money per (day, platform); both inputs are stacked and grouped once."""
    paid = purchases.filter(F.col("user_id").isNotNull() & F.col("platform_id").isNotNull()).groupBy(
        F.col("event_date").alias("date"), "platform_id"
    ).agg(
        F.count(F.lit(1)).alias("purchase_lines"),
        F.sum(F.coalesce("item_revenue", F.lit(0))).cast("decimal(18,2)").alias("revenue"),
        F.count_if(F.col("installments") > 0).alias("installment_lines"),
    )
    funnel = features.groupBy(F.col("session_date").alias("date"), "platform_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.countDistinct("user_id").alias("unique_users"),
        F.sum("events_in_session").alias("total_events"),
        _count("is_bounce").alias("bounces"),
        _count("had_view").alias("sessions_with_view"),
        _count("had_checkout").alias("sessions_with_checkout"),
        _count("had_purchase").alias("sessions_with_purchase"),
    )
    # A purchase after midnight may fall on a day on which no session began.
    counts = ("sessions", "unique_users", "total_events", "bounces", "sessions_with_view", "sessions_with_checkout",
              "sessions_with_purchase")
    both = funnel.unionByName(paid, allowMissingColumns=True).groupBy("date", "platform_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
        *[F.max(c).alias(c) for c in ("purchase_lines", "revenue", "installment_lines")],
    )
    return both.select(
        "date",
        "platform_id",
        "sessions",
        "unique_users",
        "total_events",
        "sessions_with_view",
        "sessions_with_checkout",
        "sessions_with_purchase",
        "revenue",
        rate("bounces", "sessions").alias("bounce_rate"),
        rate("sessions_with_checkout", "sessions_with_view").alias("view_to_checkout_rate_session"),
        rate("sessions_with_purchase", "sessions_with_checkout").alias("checkout_to_purchase_rate_session"),
        rate("sessions_with_purchase", "sessions").alias("overall_session_conversion_rate"),
        rate("revenue", "purchase_lines").alias("avg_order_value"),
        rate("installment_lines", "purchase_lines").alias("installment_adoption_rate"),
    )


def campaign_daily(rollup: DataFrame, touch: DataFrame, revenue: DataFrame) -> DataFrame:
    """Sessions by last-touch campaign: exposed, purchasing, conversion, revenue.

    ``revenue`` holds (session keys, revenue) of the purchases in each session.
    """
    sessions = rollup.select(*SESSION, "purchases").join(
        touch.select(*SESSION, "campaign_id"), SESSION
    )
    rows = sessions.join(revenue, SESSION, "left")
    out = rows.groupBy(F.to_date("session_start_ts").alias("date"), "platform_id", "campaign_id").agg(
        F.count(F.lit(1)).alias("sessions_exposed"),
        F.count_if(F.col("purchases") > 0).alias("sessions_with_purchase"),
        F.sum(F.coalesce("revenue", F.lit(0))).cast("decimal(18,2)").alias("total_revenue"),
    )
    return out.withColumn("session_conversion_rate", rate("sessions_with_purchase", "sessions_exposed"))


def session_revenue(sessionized_purchases: DataFrame) -> DataFrame:
    return sessionized_purchases.groupBy(*SESSION).agg(
        F.sum(F.coalesce("item_revenue", F.lit(0))).cast("decimal(18,2)").alias("revenue")
    )


def abandoned_cart_value(features: DataFrame) -> DataFrame:
    """Average cart value of abandoned sessions per (day, platform)."""
    out = (
        features.filter("is_abandoned_checkout")
        .groupBy("session_date", "platform_id")
        .agg(
            F.count(F.lit(1)).alias("abandoned_sessions"),
            F.sum("cart_value").cast("decimal(18,2)").alias("abandoned_value"),
        )
    )
    return out.withColumn("avg_abandoned_cart_value", rate("abandoned_value", "abandoned_sessions"))


def dropped_without_purchase(features: DataFrame, purchases: DataFrame) -> DataFrame:
    """Abandoned sessions whose user has not bought on that platform since; last purchase per actor decides."""
    last = purchases.groupBy(*ACTOR).agg(F.max("event_timestamp").alias("last_purchase_ts"))
    return (
        features.filter("is_abandoned_checkout")
        .join(last, ACTOR, "left")
        .filter(
            F.col("last_purchase_ts").isNull() | (F.col("last_purchase_ts") <= F.col("session_end_ts"))
        )
        .select(*SESSION, "session_end_ts", "cart_value")
    )


def _order_value(df: DataFrame, keys: list) -> DataFrame:
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("purchases"),
        F.sum(F.coalesce("item_revenue", F.lit(0))).cast("decimal(18,2)").alias("revenue"),
    )
    return out.withColumn("avg_order_value", rate("revenue", "purchases"))


def experiment_order_value(facts: DataFrame) -> DataFrame:
    """Purchases and order value per experiment variant; no variant is the control row NONE."""
    bought = facts.filter(is_event("purchase"))
    return _order_value(
        bought.withColumn("experiment_id", F.coalesce("experiment_id", F.lit("NONE"))), ["experiment_id"]
    )


def coupon_order_value(facts: DataFrame) -> DataFrame:
    """Purchases and order value per campaign code; purchases without any code are NONE."""
    used = F.coalesce(codes("campaign_codes"), F.array().cast("array<string>"))
    used = F.when(F.size(used) > 0, F.array_distinct(used)).otherwise(F.array(F.lit("NONE")))
    bought = facts.filter(is_event("purchase"))
    return _order_value(bought.withColumn("campaign_id", F.explode(used)), ["campaign_id"])


def discounts_daily(facts: DataFrame) -> DataFrame:
    """Discount given per product, campaign and day of purchase."""
    bought = facts.filter(is_event("purchase") & F.col("product_id").isNotNull())
    return (
        bought.groupBy("date_id", "product_id", "campaign_codes")
        .agg(
            F.count(F.lit(1)).alias("purchases"),
            F.sum(F.coalesce("discount_value", F.lit(0))).cast("decimal(18,2)").alias("total_discount"),
            F.max(F.coalesce("discount_value", F.lit(0))).alias("max_discount"),
        )
        .withColumn("campaign_id", F.explode(codes("campaign_codes")))
        .groupBy("date_id", "product_id", "campaign_id")
        .agg(
            F.sum("purchases").alias("purchases"),
            F.sum("total_discount").cast("decimal(18,2)").alias("total_discount"),
            F.max("max_discount").cast("decimal(10,2)").alias("max_discount"),
        )
    )


def installment_adoption(facts: DataFrame) -> DataFrame:
    """Share of purchases paid in instalments per (day, platform)."""
    out = (
        facts.filter(is_event("purchase"))
        .groupBy("date_id", "platform_id")
        .agg(
            F.count(F.lit(1)).alias("purchases"),
            F.count_if(F.col("installments") > 0).alias("installment_purchases"),
        )
    )
    return out.withColumn("adoption_rate", rate("installment_purchases", "purchases"))


def user_features(facts: DataFrame, days: int = 30) -> DataFrame:
    """Per user and active day: recency, frequency and purchases of the last ``days`` days (today included).

    Events collapse to (user, day) first, so the windows hold at most one row per calendar day.
    """
    daily = (
        facts.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.to_date("event_timestamp").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(is_event("purchase")).alias("bought"),
        )
        .withColumn("day_number", F.unix_date("day"))
    )
    order = Window.partitionBy("user_id").orderBy("day_number")
    trailing = order.rangeBetween(-(days - 1), 0)
    before = order.rangeBetween(Window.unboundedPreceding, -1)
    upto = order.rangeBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "user_id",
        "day",
        (F.col("day_number") - F.max("day_number").over(before)).alias("days_since_previous"),
        F.sum("events").over(upto).alias("events_to_date"),
        F.sum("bought").over(upto).alias("purchases_to_date"),
        F.sum("bought").over(trailing).alias(f"purchases_last_{days}_days"),
    )
