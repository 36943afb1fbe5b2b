"""The driver's ``events`` table read as staged shop events, in Spark and as SQL.

``k`` is the number in ``props``; it decides product, list, campaigns, discount and instalments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import fragment
from tidemark import schemas
from tidemark.operators import facts
from tidemark.operators.scd import conform
from tidemark.sources import lookups

RUN_TS = "2024-02-01 00:00:00"
# Driver events are minutes to hours apart, so a day-long gap gives sessions of several events.
MINUTES = 1440

#: Users, campaigns and lists that are new, and purchases that are a user's first, come from this time on; prices of a
#: product change from day to day.
LATER = "2024-01-16 00:00:00"


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def staged(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    e = events.withColumn("k", k).withColumn("v", F.col("value").cast("decimal(12,2)"))
    k = F.col("k")
    kind = F.col("event_type")
    later = F.col("ts") >= F.lit(LATER).cast("timestamp_ntz")
    name = (
        F.when((kind == "purchase") & ~later & (F.col("user_id") % 7 == 3), "other")
        .when(kind == "view", "view_item_list")
        .when(kind == "click", "view_item")
        .when(kind == "signup", "begin_checkout")
        .when(kind == "purchase", "purchase")
        .otherwise("other")
    )

    def s(prefix, n):
        return F.concat(F.lit(prefix), (k % n).cast("string"))

    paid = F.when(kind == "purchase", F.col("v") * (1 + k % 3))
    rows = e.select(
        F.col("event_id").cast("string").alias("event_id"),
        name.alias("event_name"),
        F.col("ts").alias("event_timestamp"),
        F.col("ts").alias("replay_timestamp"),
        F.when(k != 99, F.concat(F.when(later & (k % 11 == 0), "N").otherwise(""), F.col("user_id").cast("string"))).alias("user_id"),
        F.when(k == 98, "WEB").when(F.col("event_id") % 2 == 0, "IOS").when(k < 50, "android").otherwise("ANDROID").alias("platform"),
        F.when(kind == "view", F.when(later & (k % 10 == 9), "L9").otherwise(s("L", 5))).alias("item_list_id"),
        F.when(kind == "view", F.concat(F.lit("List "), (k % 5).cast("string"), F.lit(" v"), (k % 3).cast("string"))).alias("item_list_name"),
        s("P", 20).alias("product_id"),
        F.concat(F.lit("Product "), (k % 20).cast("string")).alias("product_name"),
        F.col("v").alias("price_in_usd"),
        F.col("v").alias("price"),
        (1 + k % 3).alias("quantity"),
        paid.alias("item_revenue_in_usd"),
        paid.alias("item_revenue"),
        (k % 10).alias("discount_value"),
        (F.lit(10) + (k + F.dayofmonth("ts")) % 4).alias("total_price"),
        F.when(later & (k % 9 == 1), F.concat(F.lit("E1||"), s("C", 4), F.lit("|E1")))
        .when(k % 27 == 4, "|")
        .when(k % 3 == 1, s("C", 4))
        .when(k % 3 == 2, F.concat_ws("|", s("C", 4), s("D", 2)))
        .alias("discount_campaigns"),
        F.when(k % 7 == 0, s("XP_", 3)).alias("discount_experiment_variant"),
        (k % 4).alias("installments"),
        F.when(k % 4 > 0, F.col("v")).alias("installment_price"),
        (k % 2 == 0).alias("is_in_stock"),
        F.col("props").alias("raw_event"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), k)).alias("ingestion_timestamp"),
    )
    return conform(rows, schemas.STG_EVENTS)


fragment("canon", f"""
SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(value AS DECIMAL(12,2)) AS v,
  ts >= TIMESTAMP '{LATER}' AS later FROM events
""")
fragment("stg", """
SELECT CAST(event_id AS VARCHAR) AS event_id,
  CASE WHEN event_type = 'purchase' AND NOT later AND user_id % 7 = 3 THEN 'other'
       WHEN event_type = 'view' THEN 'view_item_list' WHEN event_type = 'click' THEN 'view_item'
       WHEN event_type = 'signup' THEN 'begin_checkout' WHEN event_type = 'purchase' THEN 'purchase' ELSE 'other' END AS event_name,
  ts AS event_timestamp, ts AS replay_timestamp,
  CASE WHEN k <> 99 THEN CASE WHEN later AND k % 11 = 0 THEN 'N' ELSE '' END || user_id END AS user_id,
  CASE WHEN k = 98 THEN 'WEB' WHEN event_id % 2 = 0 THEN 'IOS' WHEN k < 50 THEN 'android' ELSE 'ANDROID' END AS platform,
  CASE WHEN event_type = 'view' THEN CASE WHEN later AND k % 10 = 9 THEN 'L9' ELSE 'L' || (k % 5) END END AS item_list_id,
  CASE WHEN event_type = 'view' THEN 'List ' || (k % 5) || ' v' || (k % 3) END AS item_list_name,
  'P' || (k % 20) AS product_id, 'Product ' || (k % 20) AS product_name,
  CAST(v AS DECIMAL(12,6)) AS price_in_usd, v AS price, 1 + k % 3 AS quantity,
  CASE WHEN event_type = 'purchase' THEN CAST(v * (1 + k % 3) AS DECIMAL(12,6)) END AS item_revenue_in_usd,
  CASE WHEN event_type = 'purchase' THEN CAST(v * (1 + k % 3) AS DECIMAL(12,2)) END AS item_revenue,
  CAST(k % 10 AS DECIMAL(10,2)) AS discount_value, CAST(10 + (k + day(ts)) % 4 AS DECIMAL(10,2)) AS total_price,
  CASE WHEN later AND k % 9 = 1 THEN 'E1||C' || (k % 4) || '|E1' WHEN k % 27 = 4 THEN '|' WHEN k % 3 = 1 THEN 'C' || (k % 4)
       WHEN k % 3 = 2 THEN 'C' || (k % 4) || '|D' || (k % 2) END AS discount_campaigns,
  CASE WHEN k % 7 = 0 THEN 'XP_' || (k % 3) END AS discount_experiment_variant,
  k % 4 AS installments, CASE WHEN k % 4 > 0 THEN CAST(v AS DECIMAL(10,2)) END AS installment_price,
  k % 2 = 0 AS is_in_stock, props AS raw_event, ts + to_hours(k) AS ingestion_timestamp
FROM canon
""")
fragment("platforms", """
SELECT * FROM (VALUES (1, 'IOS'), (2, 'ANDROID')) t(platform_id, platform_name)
""")
fragment("facts", """
SELECT s.event_id, s.event_timestamp, s.event_name, s.user_id, s.product_id, s.item_list_id, p.platform_id,
  CAST(s.event_timestamp AS DATE) AS date_id, s.discount_campaigns AS campaign_codes,
  s.discount_experiment_variant AS experiment_id, s.price_in_usd, s.price, s.quantity,
  s.item_revenue_in_usd, s.item_revenue, s.discount_value, s.total_price, s.installments,
  s.installment_price, s.is_in_stock
FROM stg s LEFT JOIN platforms p ON upper(s.platform) = p.platform_name
""")


def stg(spark: SparkSession, sf: str) -> DataFrame:
    return staged(read(spark, sf, "events"))


def fct(spark: SparkSession, sf: str) -> DataFrame:
    return facts.fct_events(stg(spark, sf), lookups.dim_platforms(spark), RUN_TS)
