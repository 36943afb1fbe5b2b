"""Batch selection, dimensions, sessions, attribution and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import fragments as frag
from catalog.adapter import MINUTES, RUN_TS, fct, read, stg
from catalog.fragments import THRESHOLD
from catalog.registry import query
from tidemark import schemas
from tidemark.functions.columns import ntz
from tidemark.operators import asof, attribution, facts, incremental, scd, sessions, upsert
from tidemark.sources import lookups

HALF = "2024-01-16 00:00:00"


def _joined(df, c):
    """Array column as sorted joined text, so that both engines compare it the same."""
    return df.withColumn(c, F.array_join(F.sort_array(c), ","))


def earlier(df, ts="event_timestamp"):
    return df.filter(F.col(ts) < ntz(HALF))


def later(df, ts="event_timestamp"):
    return df.filter(F.col(ts) >= ntz(HALF))


# --- batch selection ---


def checkpoint(spark, sf):
    """A mark as an earlier run would have left it: the greatest (time, id) before HALF."""
    mark = earlier(stg(spark, sf), "ingestion_timestamp").agg(
        F.max(F.struct("ingestion_timestamp", "event_id")).alias("m")
    )
    return mark.select(
        F.lit(incremental.PIPELINE).alias("pipeline"),
        F.col("m.ingestion_timestamp").alias("hwm_ts"),
        F.col("m.event_id").alias("hwm_event_id"),
    )


frag.fragment("mark", f"""
SELECT ingestion_timestamp AS last_ts, event_id AS last_id FROM stg
WHERE ingestion_timestamp < TIMESTAMP '{HALF}' ORDER BY ingestion_timestamp DESC, event_id DESC LIMIT 1
""")
frag.fragment("top_mark", """
SELECT ingestion_timestamp AS upper_ts, event_id AS upper_id FROM stg
ORDER BY ingestion_timestamp DESC, event_id DESC LIMIT 1
""")
frag.fragment("batch", """
SELECT s.* FROM stg s, mark m, top_mark t
WHERE (s.ingestion_timestamp > m.last_ts OR (s.ingestion_timestamp = m.last_ts AND s.event_id > m.last_id))
  AND (s.ingestion_timestamp < t.upper_ts OR (s.ingestion_timestamp = t.upper_ts AND s.event_id <= t.upper_id))
""")


@query("B1_hwm_bounds", "SELECT last_ts, last_id, upper_ts, upper_id FROM mark, top_mark")
def _(spark, sf):
    return incremental.hwm_bounds(stg(spark, sf), checkpoint(spark, sf))


def _batch(spark, sf):
    rows = stg(spark, sf)
    bounds = incremental.fetch_bounds(incremental.hwm_bounds(rows, checkpoint(spark, sf)))
    return incremental.current_batch(rows, bounds)


@query("B2_current_batch", "SELECT event_id, event_name, user_id, ingestion_timestamp FROM batch")
def _(spark, sf):
    return _batch(spark, sf).select("event_id", "event_name", "user_id", "ingestion_timestamp")


@query("B3_dedup_latest", """
SELECT event_id, event_name, user_id, platform, ingestion_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp DESC) AS rn FROM (
    SELECT * FROM stg
    UNION ALL
    SELECT * REPLACE (ingestion_timestamp + to_hours(installments) - to_hours(1) AS ingestion_timestamp) FROM stg))
WHERE rn = 1
""")
def _(spark, sf):
    rows = stg(spark, sf)
    replay = rows.withColumn(
        "ingestion_timestamp",
        F.col("ingestion_timestamp") + F.make_dt_interval(F.lit(0), F.col("installments") - 1),
    )
    return incremental.dedup_latest(rows.unionByName(replay)).select(
        "event_id", "event_name", "user_id", "platform", "ingestion_timestamp"
    )


@query("B4_net_new", f"""
SELECT b.event_id, b.event_name, b.event_timestamp FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM facts f WHERE f.event_id = b.event_id AND f.event_timestamp < TIMESTAMP '{HALF}')
""")
def _(spark, sf):
    return incremental.net_new(_batch(spark, sf), earlier(fct(spark, sf))).select(
        "event_id", "event_name", "event_timestamp"
    )


@query("B5_advance_checkpoint", f"""
SELECT 'silver_events' AS pipeline, upper_ts AS hwm_ts, upper_id AS hwm_event_id,
  (SELECT count(*) FROM batch) AS last_run_current_batch_rows,
  (SELECT count(*) FROM batch WHERE event_timestamp >= TIMESTAMP '{HALF}') AS last_run_net_new_rows,
  TIMESTAMP '{RUN_TS}' AS updated_at FROM top_mark
""")
def _(spark, sf):
    from datetime import datetime

    rows = stg(spark, sf)
    bounds = incremental.fetch_bounds(incremental.hwm_bounds(rows, checkpoint(spark, sf)))
    batch = incremental.current_batch(rows, bounds)
    counts = incremental.batch_counts(batch, incremental.net_new(batch, earlier(fct(spark, sf)))).first()
    return incremental.advance(
        spark, bounds, counts["current_batch_rows"], counts["net_new_rows"], datetime.fromisoformat(RUN_TS)
    ).drop("max_session_days")


@query("B6_batch_counts", f"""
SELECT count(*) AS current_batch_rows,
  count(*) FILTER (event_timestamp >= TIMESTAMP '{HALF}') AS net_new_rows FROM batch
""")
def _(spark, sf):
    batch = _batch(spark, sf)
    return incremental.batch_counts(batch, incremental.net_new(batch, earlier(fct(spark, sf))))


# --- insert and upsert rules ---


@query("I8_append_new", f"""
SELECT event_id, event_name, user_id FROM facts WHERE event_timestamp >= TIMESTAMP '{HALF}'
""")
def _(spark, sf):
    rows = fct(spark, sf)
    doubled = rows.unionByName(rows)
    return upsert.append_new(earlier(rows), doubled, ["event_id"]).select("event_id", "event_name", "user_id")


@query("I9_upsert_replace", f"""
SELECT product_id, max(event_date) AS event_date, arg_max(product_name, event_date) AS product_name,
  arg_max(price, event_date) AS price FROM pday GROUP BY product_id
""")
def _(spark, sf):
    def latest(df):
        days = scd.product_day(df).select("product_id", "event_date", "product_name", "price")
        return upsert.newest_per_key(days, ["product_id"], ["event_date"])

    rows = stg(spark, sf)
    return upsert.upsert_replace(latest(earlier(rows)), latest(later(rows)), ["product_id"])


@query("I10_upsert_additive", "SELECT * FROM fpc")
def _(spark, sf):
    rows = stg(spark, sf)
    dims = _campaign_dim(rows), scd.dim_products(scd.product_day(rows))
    target = facts.product_campaigns(earlier(rows), *dims)
    return upsert.upsert_additive(
        target,
        facts.product_campaigns(later(rows), *dims),
        ["product_id", "campaign_id", "price", "discount_value"],
        sums=["total_events", "views", "checkouts", "purchases", "revenue"],
        mins=["first_seen_date"],
        maxs=["last_seen_date"],
    )


# --- lookups ---


@query("I11_dim_dates", """
SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
  monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (
  SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders))
""")
def _(spark, sf):
    day = F.to_date("o_orderdate")
    return lookups.calendar(read(spark, sf, "orders").agg(F.min(day).alias("lo"), F.max(day).alias("hi")))


@query("I12_dim_platforms", """
SELECT p.platform_id, p.platform_name, count(f.event_id) AS events FROM platforms p
LEFT JOIN facts f ON f.platform_id = p.platform_id GROUP BY 1, 2
""")
def _(spark, sf):
    seen = fct(spark, sf).groupBy("platform_id").agg(F.count(F.lit(1)).alias("n"))
    return lookups.dim_platforms(spark).join(seen, "platform_id", "left").select(
        "platform_id", "platform_name", F.coalesce("n", F.lit(0)).alias("events")
    )


@query("I13_resolve_platform", """
SELECT s.event_id, s.platform, p.platform_id FROM stg s LEFT JOIN platforms p ON upper(s.platform) = p.platform_name
""")
def _(spark, sf):
    return lookups.resolve_platform(stg(spark, sf), lookups.dim_platforms(spark)).select(
        "event_id", "platform", "platform_id"
    )


# --- dimensions ---


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


def _users(spark, rows):
    empty = _empty(spark, schemas.DIM_USERS)
    return scd.merge_users(empty, scd.user_changes(rows, empty))


def _user_first_sql(condition: str) -> str:
    return f"""
SELECT user_id, min(CAST(event_timestamp AS DATE)) AS first_event,
  min(CAST(event_timestamp AS DATE)) FILTER (event_name = 'purchase') AS first_buy,
  min(CAST(event_timestamp AS DATE)) FILTER (event_name = 'purchase' AND coalesce(installments, 0) > 0) AS first_inst
FROM stg WHERE user_id IS NOT NULL AND {condition} GROUP BY user_id
"""


frag.fragment("u_old", _user_first_sql(f"event_timestamp < TIMESTAMP '{HALF}'"))
frag.fragment("u_new", _user_first_sql(f"event_timestamp >= TIMESTAMP '{HALF}'"))
frag.fragment("u_changes", """
WITH seen AS (
  SELECT coalesce(n.user_id, o.user_id) AS user_id, o.user_id IS NULL AS is_new, n.first_event AS came,
    n.first_buy AS buy, n.first_inst AS inst, o.first_buy AS old_buy, o.first_inst AS old_inst
  FROM u_new n FULL JOIN u_old o USING (user_id)),
marked AS (
  SELECT *, CASE WHEN is_new THEN came END AS d_new,
    CASE WHEN NOT is_new AND buy < coalesce(old_buy, DATE '9999-12-31') THEN buy END AS d_buy,
    CASE WHEN NOT is_new AND old_inst IS NULL THEN inst END AS d_inst
  FROM seen)
SELECT user_id, least(d_new, d_buy, d_inst) AS change_date,
  CASE WHEN is_new OR d_buy IS NOT NULL THEN buy ELSE old_buy END AS first_purchase_date,
  coalesce(CASE WHEN is_new THEN inst ELSE old_inst END, d_inst) IS NOT NULL AS has_used_installments
FROM marked WHERE least(d_new, d_buy, d_inst) IS NOT NULL
""")


@query("S1_user_changes", "SELECT * FROM u_changes")
def _(spark, sf):
    rows = stg(spark, sf)
    return scd.user_changes(later(rows), _users(spark, earlier(rows)))


@query("S1_dim_users_two_batches", """
SELECT user_id, first_purchase_date, has_used_installments, effective_start_date,
  lead(effective_start_date) OVER (PARTITION BY user_id ORDER BY effective_start_date) AS effective_end_date,
  lead(effective_start_date) OVER (PARTITION BY user_id ORDER BY effective_start_date) IS NULL AS is_active
FROM (
  SELECT user_id, first_buy AS first_purchase_date, first_inst IS NOT NULL AS has_used_installments,
    first_event AS effective_start_date FROM u_old
  UNION ALL
  SELECT user_id, first_purchase_date, has_used_installments, change_date FROM u_changes)
""")
def _(spark, sf):
    rows = stg(spark, sf)
    dim = _users(spark, earlier(rows))
    return scd.merge_users(dim, scd.user_changes(later(rows), dim)).select(
        "user_id", "first_purchase_date", "has_used_installments",
        "effective_start_date", "effective_end_date", "is_active",
    )


@query("S2_product_day", "SELECT * FROM pday")
def _(spark, sf):
    return scd.product_day(stg(spark, sf)).select("product_id", "event_date", "product_name", "price")


@query("S3_product_changes", f"""
SELECT product_id, event_date AS change_date, product_name, price FROM (
  SELECT *, lag(product_name) OVER w AS n, lag(price) OVER w AS p, lag(event_date) OVER w AS d FROM pday
  WINDOW w AS (PARTITION BY product_id ORDER BY event_date))
WHERE event_date >= DATE '{HALF[:10]}' AND (d IS NULL OR n IS DISTINCT FROM product_name OR p IS DISTINCT FROM price)
""")
def _(spark, sf):
    rows = stg(spark, sf)
    return scd.product_changes(
        scd.product_day(later(rows)), scd.dim_products(scd.product_day(earlier(rows)))
    )


#: Order lines to a task, and shares that the lines of one part and day are collapsed in.
TASK_ROWS, SHARES = 500_000, 8


def line_parts(spark, sf):
    """Partitions for all order lines: their number follows the table, so a task's memory does not."""
    return max(spark.sparkContext.defaultParallelism, -(-read(spark, sf, "lineitem").count() // TASK_ROWS))


def line_days(spark, sf, parts=None):
    parts = parts or line_parts(spark, sf)
    last = F.struct(
        "l_shipdate", "l_orderkey", "l_linenumber", F.floor(F.col("l_discount") * 20).cast("int").alias("disc")
    )
    lines = read(spark, sf, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("ship_day"), F.pmod("l_orderkey", F.lit(SHARES)).alias("share"), last.alias("last")
    )
    shares = (
        lines.repartition(parts, "l_partkey", "ship_day", "share")
        .groupBy("l_partkey", "ship_day", "share")
        .agg(F.max("last").alias("last"))
    )
    # Partitioned by the part alone: the days' last lines and the windows over them need no other shuffle.
    days = shares.repartition(parts, "l_partkey").groupBy("l_partkey", "ship_day").agg(F.max("last").alias("last"))
    return days.select("l_partkey", "ship_day", "last.disc")


def line_versions(spark, sf, parts=None):
    return scd.timeline(line_days(spark, sf, parts), "l_partkey", "ship_day", ["disc"])


@query("S4_scd2_merge", """
SELECT l_partkey, disc, d AS effective_start_date,
  lead(d) OVER (PARTITION BY l_partkey ORDER BY d) AS effective_end_date,
  lead(d) OVER (PARTITION BY l_partkey ORDER BY d) IS NULL AS is_active
FROM (
  SELECT coalesce(v.l_partkey, r.l_partkey) AS l_partkey, coalesce(r.disc, v.disc) AS disc,
    coalesce(v.effective_start_date, r.d) AS d
  FROM lver v FULL JOIN (
    SELECT l_partkey, CAST(l_shipdate AS DATE) AS d, max(l_linenumber) + 100 AS disc FROM lineitem
    WHERE l_returnflag = 'R' GROUP BY 1, 2) r
  ON r.l_partkey = v.l_partkey AND r.d = v.effective_start_date)
""")
def _(spark, sf):
    returned = (
        read(spark, sf, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .groupBy("l_partkey", F.to_date("l_shipdate").alias("change_date"))
        .agg((F.max("l_linenumber") + 100).cast("int").alias("disc"))
    )
    parts = line_parts(spark, sf)
    return scd.scd2_merge(line_versions(spark, sf, parts), returned, "l_partkey", ["disc"], parts)


@query("S5_close_intervals", """
SELECT l_suppkey, d AS effective_start_date, lead(d) OVER (PARTITION BY l_suppkey ORDER BY d) AS effective_end_date,
  lead(d) OVER (PARTITION BY l_suppkey ORDER BY d) IS NULL AS is_active
FROM (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS d FROM lineitem)
""")
def _(spark, sf):
    starts = read(spark, sf, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("effective_start_date")
    ).distinct()
    return scd.close_intervals(starts, "l_suppkey")


@query("S6_open_versions", "SELECT * FROM lver")
def _(spark, sf):
    return line_versions(spark, sf)


@query("S6_dim_products", "SELECT * FROM dprod")
def _(spark, sf):
    return scd.dim_products(scd.product_day(stg(spark, sf))).drop("product_sk")


@query("S7_item_lists_insert_unseen", """
SELECT item_list_id, item_list_id AS item_list_name, min(CAST(event_timestamp AS DATE)) AS effective_start_date,
  CAST(NULL AS DATE) AS effective_end_date, true AS is_active
FROM stg WHERE item_list_id IS NOT NULL GROUP BY item_list_id
""")
def _(spark, sf):
    seen = scd.first_seen(stg(spark, sf), "item_list_id").withColumn("item_list_name", F.col("item_list_id"))
    return scd.scd_insert_unseen(_empty(spark, schemas.DIM_ITEM_LISTS), seen, "item_list_id").select(
        "item_list_id", "item_list_name", "effective_start_date", "effective_end_date", "is_active"
    )


@query("S8_item_lists_name_refresh", """
SELECT item_list_id, arg_max(item_list_name, (event_timestamp, event_id)) AS item_list_name,
  min(CAST(event_timestamp AS DATE)) AS effective_start_date, true AS is_active
FROM stg WHERE item_list_id IS NOT NULL GROUP BY item_list_id
""")
def _(spark, sf):
    rows = stg(spark, sf)
    first = scd.merge_item_lists(_empty(spark, schemas.DIM_ITEM_LISTS), earlier(rows))
    return scd.merge_item_lists(first, later(rows)).select(
        "item_list_id", "item_list_name", "effective_start_date", "is_active"
    )


def _campaign_dim(rows):
    return scd.merge_campaigns(_empty(rows.sparkSession, schemas.DIM_CAMPAIGNS), rows)


@query("S9_campaigns_insert_unseen", "SELECT * FROM dcamp")
def _(spark, sf):
    rows = stg(spark, sf)
    both = scd.merge_campaigns(_campaign_dim(earlier(rows)), later(rows))
    return both.select(
        "campaign_id", "campaign_name", "effective_start_date", "effective_end_date", "is_active"
    )


@query("S10_experiments_insert_unseen", """
SELECT discount_experiment_variant AS experiment_id, discount_experiment_variant AS experiment_name,
  discount_experiment_variant AS variant_name, min(CAST(event_timestamp AS DATE)) AS effective_start_date,
  true AS is_active FROM stg WHERE discount_experiment_variant IS NOT NULL GROUP BY 1
""")
def _(spark, sf):
    rows = stg(spark, sf)
    first = scd.merge_experiments(_empty(spark, schemas.DIM_EXPERIMENTS), earlier(rows))
    return scd.merge_experiments(first, later(rows)).select(
        "experiment_id", "experiment_name", "variant_name", "effective_start_date", "is_active"
    )


@query("S11_active_rows", "SELECT l_partkey, disc, effective_start_date FROM lver WHERE is_active")
def _(spark, sf):
    return scd.active(line_versions(spark, sf)).select("l_partkey", "disc", "effective_start_date")


@query("S12_point_in_time_join", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(l.l_shipdate AS DATE) AS ship_day, v.disc, v.effective_start_date
FROM lineitem l JOIN lver v ON v.l_partkey = l.l_partkey AND v.effective_start_date <= CAST(l.l_shipdate AS DATE)
  AND (v.effective_end_date IS NULL OR CAST(l.l_shipdate AS DATE) < v.effective_end_date)
""")
def _(spark, sf):
    lines = read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ship_day")
    )
    return scd.as_of_join(lines, line_versions(spark, sf), "l_partkey", "ship_day").select(
        "l_orderkey", "l_linenumber", "l_partkey", "ship_day", "disc", "effective_start_date"
    )


# --- sessions ---


@query("E1_impacted_actors", """
SELECT DISTINCT user_id, platform_id FROM facts WHERE user_id IS NOT NULL AND platform_id IS NOT NULL
""")
def _(spark, sf):
    return sessions.impacted(fct(spark, sf))


def _old_sessions(old):
    return sessions.rollup_sessions(sessions.session_rollup(old, MINUTES))


# Stored events that end up in one session with a new event; DuckDB finds them from the full sessionization.
frag.fragment("old_sess", frag.sessionized_sql(f"(SELECT * FROM facts WHERE event_timestamp < TIMESTAMP '{HALF}')"))
frag.fragment("touched", f"""
SELECT DISTINCT session_id FROM sess WHERE event_timestamp >= TIMESTAMP '{HALF}'
""")


@query("E2_prehistory", f"""
SELECT s.event_id, s.user_id, s.platform_id, s.event_timestamp FROM sess s JOIN touched USING (session_id)
WHERE s.event_timestamp < TIMESTAMP '{HALF}'
""")
def _(spark, sf):
    rows = fct(spark, sf)
    old, new = earlier(rows), later(rows)
    affected = sessions.affected_sessions(_old_sessions(old), new, MINUTES)
    return sessions.prehistory(sessions.sessionize(old, MINUTES), affected, new).select(
        "event_id", "user_id", "platform_id", "event_timestamp"
    )


@query("E3_events_window", f"""
SELECT s.event_id, s.event_name, s.user_id, s.platform_id, s.event_timestamp FROM sess s JOIN touched USING (session_id)
""")
def _(spark, sf):
    rows = fct(spark, sf)
    old, new = earlier(rows), sessions.sessionizable(later(rows))
    affected = sessions.affected_sessions(_old_sessions(old), new, MINUTES)
    prior = sessions.prehistory(sessions.sessionize(old, MINUTES), affected, new)
    return sessions.events_window(new, prior).select(
        "event_id", "event_name", "user_id", "platform_id", "event_timestamp"
    )


@query("E4_sessionize", """
SELECT event_id, event_name, event_timestamp, user_id, platform_id, session_start_ts, session_date, session_id FROM sess
""")
def _(spark, sf):
    return sessions.sessionize(fct(spark, sf), MINUTES).select(
        "event_id", "event_name", "event_timestamp", "user_id", "platform_id",
        "session_start_ts", "session_date", "session_id",
    )


@query("E4_sessionize_30_minutes", frag.sessions_sql(f"({frag.sessionized_sql('facts', 30)})"))
def _(spark, sf):
    return sessions.user_sessions(sessions.sessionize(fct(spark, sf), 30))


@query("E4_merge_late_batch", "SELECT event_id, user_id, platform_id, session_start_ts, session_id FROM sess")
def _(spark, sf):
    # Every third hour arrives late, so the batch extends, bridges and precedes stored sessions.
    rows = fct(spark, sf)
    late = F.hour("event_timestamp").isin(2, 5, 8, 11, 14, 17, 20, 23)
    old, new = rows.filter(~late), rows.filter(late)
    state = sessions.sessionize(old, MINUTES)
    return sessions.merge_sessionized(state, _old_sessions(old), new, MINUTES).select(
        "event_id", "user_id", "platform_id", "session_start_ts", "session_id"
    )


@query("E6_user_sessions", "SELECT * FROM usess")
def _(spark, sf):
    return sessions.rollup_sessions(sessions.session_rollup(fct(spark, sf), MINUTES))


@query("E7_cart_metrics", """
SELECT * REPLACE (array_to_string(cart_products, ',') AS cart_products) FROM cart
""")
def _(spark, sf):
    rows = fct(spark, sf)
    return _joined(
        sessions.cart_metrics(_old_sessions(rows), rows, MINUTES), "cart_products"
    )


FEATURES_SQL = "SELECT * REPLACE (array_to_string(cart_products, ',') AS cart_products) FROM feat"


def features(spark, sf):
    return sessions.rollup_features(sessions.session_rollup(fct(spark, sf), MINUTES), THRESHOLD)


@query("E8_session_features", FEATURES_SQL)
def _(spark, sf):
    return _joined(features(spark, sf), "cart_products")


@query("E8_session_features_joined", FEATURES_SQL)
def _(spark, sf):
    rows = fct(spark, sf)
    found = sessions.user_sessions(sessions.sessionize(rows, MINUTES))
    cart = sessions.cart_metrics(found, rows, MINUTES)
    return _joined(sessions.session_features(found, cart, THRESHOLD), "cart_products")


@query("E9_list_impressions", "SELECT * FROM imps")
def _(spark, sf):
    return impressions(spark, sf)


def impressions(spark, sf):
    return sessions.list_impressions(fct(spark, sf), MINUTES)


@query("E10_distinct_impressions", """
SELECT DISTINCT user_id, platform_id, session_id, session_start_ts, session_date, item_list_id, impression_ts,
  CAST(impression_ts AS DATE) AS date_id FROM imps
""")
def _(spark, sf):
    return sessions.distinct_impressions(impressions(spark, sf))


# --- attribution ---


@query("A1_actionable_events", """
SELECT event_id, event_name, user_id FROM facts
WHERE event_name IN ('view_item', 'begin_checkout', 'purchase') AND user_id IS NOT NULL
""")
def _(spark, sf):
    return attribution.actionable(fct(spark, sf)).select("event_id", "event_name", "user_id")


@query("A2_last_touch", """
SELECT event_id, event_name, user_id, platform_id, session_id, session_start_ts, item_list_id, impression_ts_chosen
FROM attr
""")
def _(spark, sf):
    return attribution.last_touch(fct(spark, sf), MINUTES).select(
        "event_id", "event_name", "user_id", "platform_id", "session_id", "session_start_ts",
        "item_list_id", "impression_ts_chosen",
    )


def attributed(spark, sf):
    return attribution.list_attribution(attribution.last_touch(fct(spark, sf), MINUTES), MINUTES)


@query("A3_list_attribution", f"""
SELECT event_id, user_id, event_name, event_timestamp, item_list_id, platform_id, session_id, session_start_ts,
  impression_ts_chosen, 'last_touch_session' AS attribution_model, {MINUTES} AS window_minutes,
  1 AS attribution_version, CAST(event_timestamp AS DATE) AS date_id, item_revenue_in_usd, installments, session_date
FROM attr WHERE item_list_id IS NOT NULL
""")
def _(spark, sf):
    return attributed(spark, sf)


TOUCH_SQL = "SELECT *, CAST(session_start_ts AS DATE) AS session_date FROM ctouch"


@query("A4_campaign_last_touch", TOUCH_SQL)
def _(spark, sf):
    return touch(spark, sf)


def touch(spark, sf):
    return attribution.rollup_campaign_touch(sessions.session_rollup(fct(spark, sf), MINUTES))


@query("A4_campaign_last_touch_from_events", TOUCH_SQL)
def _(spark, sf):
    return attribution.campaign_last_touch(sessions.sessionize(fct(spark, sf), MINUTES))


def _asof_sides(spark, sf):
    rows = stg(spark, sf).withColumnRenamed("event_timestamp", "ts")
    left = rows.filter(F.col("event_name") == "purchase").select("event_id", "user_id", "ts")
    right = rows.filter(F.col("event_name") == "view_item_list").select(
        "user_id", "ts", F.col("item_list_id"), F.col("event_id").alias("view_id")
    )
    return left, right


def _asof_columns(df):
    return df.select(
        "event_id", "user_id", "ts", F.col("matched.item_list_id").alias("item_list_id"),
        F.col("matched.view_id").alias("view_id"), F.col("matched.matched_on").alias("matched_on"),
    )


_ASOF_SQL = """
WITH l AS (SELECT event_id, user_id, event_timestamp AS ts FROM stg WHERE event_name = 'purchase'),
r AS (SELECT user_id, event_timestamp AS ts, item_list_id, event_id AS view_id FROM stg
      WHERE event_name = 'view_item_list' AND user_id IS NOT NULL)
SELECT l.event_id, l.user_id, l.ts, {cols} FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts {op} r.ts
"""


@query("A5_asof_join", _ASOF_SQL.format(
    op=">=", cols="r.item_list_id, r.view_id, r.ts AS matched_on"))
def _(spark, sf):
    left, right = _asof_sides(spark, sf)
    return _asof_columns(asof.asof_join(left, right, "ts", ["user_id"]))


_NEAR = "r.ts - l.ts <= INTERVAL '6 hours'"


@query("A5_asof_join_forward_tolerance", _ASOF_SQL.format(
    op="<=", cols=", ".join(f"CASE WHEN {_NEAR} THEN {c} END AS {a}" for c, a in (
        ("r.item_list_id", "item_list_id"), ("r.view_id", "view_id"), ("r.ts", "matched_on")))))
def _(spark, sf):
    left, right = _asof_sides(spark, sf)
    return _asof_columns(
        asof.asof_join(left, right, "ts", ["user_id"], direction="forward", tolerance="6 hours")
    )


# --- facts ---


@query("F1_fct_events", f"""
SELECT *, TIMESTAMP '{RUN_TS}' AS ingestion_timestamp, TIMESTAMP '{RUN_TS}' AS updated_at FROM facts
""")
def _(spark, sf):
    return fct(spark, sf)


def product_campaigns(spark, sf):
    rows = stg(spark, sf)
    return facts.product_campaigns(rows, _campaign_dim(rows), scd.dim_products(scd.product_day(rows)))


@query("F2_product_campaigns", "SELECT * FROM fpc")
def _(spark, sf):
    return product_campaigns(spark, sf)


@query("F3_product_daily", "SELECT * FROM pdaily")
def _(spark, sf):
    return facts.product_daily(stg(spark, sf))


@query("F4_purchases", "SELECT * FROM bought")
def _(spark, sf):
    return facts.purchases(fct(spark, sf))


def campaign_dim(spark, sf):
    return _campaign_dim(stg(spark, sf))


def product_dim(spark, sf):
    return scd.dim_products(scd.product_day(stg(spark, sf)))
