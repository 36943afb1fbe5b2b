"""Gold tables: lazy DataFrames over silver and the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import is_event, rate
from tidemark.operators.scd import END, START, active, as_of_join, covers
from tidemark.operators.sessions import ACTOR, SESSION

SEGMENTS = {
    "bounce": "is_bounce",
    "checkout_abandon": "is_abandoned_checkout",
    "high_value_abandon": "is_high_value_abandoned_checkout",
}


def price_change_events(
    dim_products: DataFrame, dim_campaigns: DataFrame, fpc: DataFrame, distinct: bool = False
) -> DataFrame:
    """Price changes of products while a campaign they were seen in was running."""
    order = Window.partitionBy("product_id").orderBy("effective_start_date")
    changes = (
        dim_products.select(
            "product_id",
            F.lag("price").over(order).alias("old_price"),
            F.col("price").alias("new_price"),
            F.col("effective_start_date").alias("change_date"),
        )
        .filter(F.col("old_price").isNotNull() & ~F.col("new_price").eqNullSafe(F.col("old_price")))
    )
    seen = fpc.select("product_id", "campaign_id", "first_seen_date", "last_seen_date")
    observed = changes.join(seen, "product_id").filter(
        F.col("change_date").between(F.col("first_seen_date"), F.col("last_seen_date"))
    )
    campaigns = dim_campaigns.select(
        F.col("campaign_id"), "campaign_name", "effective_start_date", "effective_end_date"
    )
    rows = observed.join(campaigns, "campaign_id").filter(covers(F.col("change_date"))).select(
        "campaign_id",
        "campaign_name",
        "product_id",
        "change_date",
        "old_price",
        "new_price",
        rate(F.col("new_price") - F.col("old_price"), "old_price").alias("delta_pct"),
    )
    return rows.distinct() if distinct else rows


def current_status(
    dim_products: DataFrame, dim_campaigns: DataFrame, fpc: DataFrame, as_of_date
) -> DataFrame:
    """Active campaign x active product with the current price and discount flags."""
    today = F.col("last_seen_date") == F.lit(as_of_date).cast("date")
    discounted = F.col("discount_value") > 0
    # Only the greatest discount per pair matters, today and ever.
    pairs = fpc.groupBy("campaign_id", "product_id").agg(
        F.max(F.when(discounted & today, 1).otherwise(0)).alias("has_discount_today"),
        F.max(F.when(discounted, 1).otherwise(0)).alias("has_discount_recent"),
        F.max(F.when(today, F.col("discount_value"))).alias("discount_today"),
    )
    return (
        pairs.join(active(dim_campaigns).select("campaign_id", "campaign_name"), "campaign_id")
        .join(
            active(dim_products).select("product_id", F.col("price").alias("current_price")), "product_id"
        )
        .select(
            "campaign_id",
            "campaign_name",
            "product_id",
            "current_price",
            "has_discount_today",
            "has_discount_recent",
            F.coalesce(rate("discount_today", "current_price") * 100, F.lit(0.0)).alias(
                "current_discount_percentage"
            ),
        )
    )


def session_list_flags(impressions: DataFrame, attribution: DataFrame) -> DataFrame:
    """One row per (session, list): impressions and whether it led to a click, checkout, purchase.

    Exposures and attributed events are stacked and grouped once, which equals their full outer join on
    (session, list) and combines map-side.
    """
    keys = [*ACTOR, "session_id", "item_list_id"]
    day = F.col("session_date").alias("date")
    seen = impressions.select(*keys, day, F.lit(1).alias("imp"), F.lit(None).cast("string").alias("event_name"))
    acted = attribution.select(*keys, day, F.lit(0).alias("imp"), "event_name")

    def flag(name):
        return F.max(F.when(is_event(name), 1).otherwise(0))

    return (
        seen.unionByName(acted)
        .groupBy(*keys)
        .agg(
            F.min("date").alias("date"),  # the same in all rows of a session
            F.sum("imp").alias("impressions"),
            F.max("imp").alias("session_exposed"),
            flag("view_item").alias("had_click"),
            flag("begin_checkout").alias("had_checkout"),
            flag("purchase").alias("had_purchase"),
        )
    )


def _engagement(rows: DataFrame, keys: list) -> DataFrame:
    # Rows are unique per (session, list) and the list is a key, so counting rows counts sessions.
    out = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("session_exposed").alias("sessions_exposed"),
        F.sum("impressions").alias("list_impressions"),
        F.sum("had_click").alias("sessions_with_click"),
        F.sum("had_checkout").alias("sessions_with_checkout"),
        F.sum("had_purchase").alias("sessions_with_purchase"),
    )
    return out.select(
        "*",
        rate("sessions_with_click", "sessions_exposed").alias("ctr_sessions"),
        rate("sessions_with_purchase", "sessions_exposed").alias("purchase_rate_on_exposure"),
        rate("sessions_with_purchase", "sessions_with_click").alias("purchase_rate_on_click"),
    )


def engagement_daily(impressions: DataFrame, attribution: DataFrame, touch: DataFrame) -> DataFrame:
    campaigns = touch.select(*ACTOR, "session_id", "campaign_id")
    rows = (
        session_list_flags(impressions, attribution)
        .join(campaigns, [*ACTOR, "session_id"], "left")
        .withColumn("campaign_id", F.coalesce("campaign_id", F.lit("NONE")))
    )
    return _engagement(rows, ["date", "platform_id", "campaign_id", "item_list_id"])


def list_daily(impressions: DataFrame, attribution: DataFrame) -> DataFrame:
    """The same without the campaign split."""
    return _engagement(session_list_flags(impressions, attribution), ["date", "platform_id", "item_list_id"])


def finance_daily(purchases: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Daily purchases by the user segment valid on the day.

    Purchases collapse to (user, day) before the dimension join; sums and counts add up exactly.
    """

    def total(c):
        return F.sum(F.coalesce(F.col(c), F.lit(0))).cast("decimal(18,2)")

    per_user = purchases.groupBy("user_id", "event_date").agg(
        F.count(F.lit(1)).alias("purchases"),
        total("total_price").alias("total_original_price"),
        total("item_revenue").alias("total_revenue"),
        total("discount_value").alias("total_discount_value"),
        F.count_if(F.col("installments") > 0).alias("purchases_with_installments"),
        total("installment_price").alias("total_installment_value"),
    )
    segments = ["region", "customer_segment", "risk_segment"]
    users = dim_users.select("user_id", *segments, START, END)
    joined = as_of_join(per_user, users, "user_id", "event_date")
    money = ["total_original_price", "total_revenue", "total_discount_value", "total_installment_value"]
    out = joined.groupBy("event_date", *segments).agg(
        F.sum("purchases").alias("purchases"),
        *[F.sum(c).cast("decimal(18,2)").alias(c) for c in money],
        F.sum("purchases_with_installments").alias("purchases_with_installments"),
    )
    return out.withColumn("avg_order_value", rate("total_revenue", "purchases"))


def abandon_then_bought_different(features: DataFrame, purchases: DataFrame) -> DataFrame:
    """Abandoned sessions whose user later bought, on the same platform, something not in the cart.

    A product counts for a session when its *last* purchase is after the session end. So it is enough to
    know, per actor, the last purchase of each product: the session qualifies when more products were
    bought after its end than cart products were. No session is paired with all later purchases.
    """
    bought = purchases.groupBy(*ACTOR, "product_id").agg(F.max("event_timestamp").alias("last_ts"))
    abandoned = features.filter("is_abandoned_checkout").select(
        *SESSION, "session_end_ts", "cart_products"
    )
    # Products bought after each session end: a count over the actor's products, latest first.
    marks = bought.select(*ACTOR, F.col("last_ts").alias("at"), F.lit(1).alias("product"))
    ends = abandoned.select(
        *ACTOR,
        F.col("session_end_ts").alias("at"),
        F.lit(0).alias("product"),
        "session_start_ts",
    )
    latest_first = Window.partitionBy(*ACTOR).orderBy(F.desc("at"), "product")
    later = (
        ends.unionByName(marks, allowMissingColumns=True)
        .withColumn("later_products", F.sum("product").over(latest_first.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("product") == 0)
        .select(*SESSION, "later_products")
    )
    in_cart = (
        abandoned.select(*SESSION, "session_end_ts", F.explode("cart_products").alias("product_id"))
        .join(bought, [*ACTOR, "product_id"])
        .filter(F.col("last_ts") > F.col("session_end_ts"))
        .groupBy(*SESSION)
        .agg(F.count(F.lit(1)).alias("later_cart_products"))
    )
    return (
        later.join(in_cart, SESSION, "left")
        .filter(F.col("later_products") > F.coalesce("later_cart_products", F.lit(0)))
        .select(*SESSION)
    )


def segment(features: DataFrame, name: str) -> DataFrame:
    return features.filter(F.col(SEGMENTS[name]))


def product_metrics(daily: DataFrame) -> DataFrame:
    positive = F.when(F.col("views") > 0, F.col("views"))
    return daily.select(
        "*",
        rate("checkouts", positive).alias("view_to_checkout_rate"),
        rate("purchases", positive).alias("view_to_purchase_rate"),
    )
