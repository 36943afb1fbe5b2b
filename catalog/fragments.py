"""SQL fragments for sessions, attribution, dimensions and facts, written from the reference semantics."""

from __future__ import annotations

from catalog.adapter import MINUTES
from catalog.registry import fragment


def sessionized_sql(base: str, minutes: int = MINUTES) -> str:
    return f"""
SELECT * EXCLUDE (prev, seq),
  CAST(session_start_ts AS DATE) AS session_date,
  user_id || ':' || platform_id || ':' || CAST(session_start_ts AS VARCHAR) AS session_id
FROM (
  SELECT *, min(event_timestamp) OVER (PARTITION BY user_id, platform_id, seq) AS session_start_ts
  FROM (
    SELECT *, sum(CASE WHEN prev IS NULL OR event_timestamp - prev > INTERVAL '{minutes} minutes' THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id, platform_id ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS seq
    FROM (
      SELECT *, lag(event_timestamp) OVER (PARTITION BY user_id, platform_id ORDER BY event_timestamp, event_id) AS prev
      FROM {base} WHERE user_id IS NOT NULL AND platform_id IS NOT NULL)))
"""


def sessions_sql(base: str) -> str:
    return f"""
SELECT user_id, platform_id, session_start_ts, max(event_timestamp) AS session_end_ts,
  min(session_date) AS session_date, CAST(count(*) AS INTEGER) AS events_in_session,
  CAST(count(*) FILTER (event_name = 'view_item') AS INTEGER) AS views,
  CAST(count(*) FILTER (event_name = 'begin_checkout') AS INTEGER) AS checkouts,
  CAST(count(*) FILTER (event_name = 'purchase') AS INTEGER) AS purchases
FROM {base} GROUP BY user_id, platform_id, session_start_ts
"""


def cart_sql(sessions: str, events: str) -> str:
    return f"""
SELECT s.user_id, s.platform_id, s.session_start_ts,
  CAST(sum(f.price * f.quantity) AS DECIMAL(18,2)) AS cart_value,
  list_sort(list_distinct(list(f.product_id) FILTER (f.product_id IS NOT NULL))) AS cart_products
FROM {sessions} s JOIN {events} f ON f.user_id = s.user_id AND f.platform_id = s.platform_id
  AND f.event_timestamp BETWEEN s.session_start_ts AND s.session_end_ts
WHERE f.event_name = 'begin_checkout' GROUP BY ALL
"""


def features_sql(sessions: str, cart: str, threshold: int) -> str:
    return f"""
SELECT s.user_id, s.platform_id, s.session_start_ts, s.session_end_ts, s.session_date, s.events_in_session,
  s.views > 0 AS had_view, s.checkouts > 0 AS had_checkout, s.purchases > 0 AS had_purchase,
  s.events_in_session = 1 AS is_bounce, s.checkouts > 0 AND s.purchases = 0 AS is_abandoned_checkout,
  coalesce(c.cart_value, 0) AS cart_value, c.cart_products,
  s.checkouts > 0 AND s.purchases = 0 AND coalesce(c.cart_value, 0) > {threshold} AS is_high_value_abandoned_checkout
FROM {sessions} s LEFT JOIN {cart} c USING (user_id, platform_id, session_start_ts)
"""


THRESHOLD = 100

fragment("sess", sessionized_sql("facts"))
fragment("usess", sessions_sql("sess"))
fragment("cart", cart_sql("usess", "facts"))
fragment("feat", features_sql("usess", "cart", THRESHOLD))
fragment("imps", """
SELECT event_id, user_id, platform_id, item_list_id, event_timestamp AS impression_ts,
  session_start_ts, session_date, session_id
FROM sess WHERE event_name = 'view_item_list' AND item_list_id IS NOT NULL
""")
# All list views of the session up to the event, the latest first; the join form of the correlated lookup.
fragment("attr", f"""
SELECT * FROM (
  SELECT se.event_id, se.user_id, se.platform_id, se.event_name, se.event_timestamp, se.session_id,
    se.session_start_ts, se.session_date, se.item_revenue_in_usd, se.installments,
    li.item_list_id, li.impression_ts AS impression_ts_chosen,
    row_number() OVER (PARTITION BY se.event_id ORDER BY li.impression_ts DESC NULLS LAST, li.event_id DESC) AS rn
  FROM sess se LEFT JOIN imps li ON li.user_id = se.user_id AND li.platform_id = se.platform_id
    AND li.session_id = se.session_id AND li.impression_ts <= se.event_timestamp
  WHERE se.event_name IN ('view_item', 'begin_checkout', 'purchase'))
WHERE rn = 1
""")
fragment("ctouch", """
SELECT user_id, platform_id, session_id, session_start_ts, campaign_id, event_timestamp AS last_touch_ts
FROM (
  SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp DESC, event_id DESC, campaign_id DESC) AS rn
  FROM (SELECT *, unnest(string_split(campaign_codes, '|')) AS campaign_id FROM sess
        WHERE campaign_codes IS NOT NULL AND campaign_codes <> '') WHERE campaign_id <> '')
WHERE rn = 1
""")
fragment("bought", """
SELECT event_id, user_id, platform_id, product_id, item_list_id, item_revenue, installments, installment_price,
  total_price, price, discount_value, quantity, event_timestamp, CAST(event_timestamp AS DATE) AS event_date
FROM facts WHERE event_name = 'purchase'
""")
fragment("pday", """
SELECT product_id, event_date, product_name, price FROM (
  SELECT product_id, CAST(event_timestamp AS DATE) AS event_date, product_name,
    CAST(total_price AS DECIMAL(12,2)) AS price,
    row_number() OVER (PARTITION BY product_id, CAST(event_timestamp AS DATE)
      ORDER BY event_timestamp DESC, event_id DESC) AS rn
  FROM stg WHERE product_id IS NOT NULL) WHERE rn = 1
""")
fragment("dprod", """
SELECT product_id, product_name, price, event_date AS effective_start_date,
  lead(event_date) OVER (PARTITION BY product_id ORDER BY event_date) AS effective_end_date,
  lead(event_date) OVER (PARTITION BY product_id ORDER BY event_date) IS NULL AS is_active
FROM (
  SELECT *, lag(event_date) OVER w AS d, lag(product_name) OVER w AS n, lag(price) OVER w AS p FROM pday
  WINDOW w AS (PARTITION BY product_id ORDER BY event_date))
WHERE d IS NULL OR n IS DISTINCT FROM product_name OR p IS DISTINCT FROM price
""")
fragment("codes", """
SELECT * FROM (SELECT *, unnest(string_split(discount_campaigns, '|')) AS campaign_id FROM stg
  WHERE discount_campaigns IS NOT NULL) WHERE campaign_id <> ''
""")
fragment("dcamp", """
SELECT campaign_id, campaign_id AS campaign_name, min(CAST(event_timestamp AS DATE)) AS effective_start_date,
  CAST(NULL AS DATE) AS effective_end_date, true AS is_active FROM codes GROUP BY campaign_id
""")
fragment("code_days", """
SELECT product_id, campaign_id, CAST(event_timestamp AS DATE) AS event_date, coalesce(discount_value, 0) AS discount_value,
  count(*) AS n, count_if(event_name = 'view_item') AS v, count_if(event_name = 'begin_checkout') AS c,
  count_if(event_name = 'purchase') AS b, sum(item_revenue) FILTER (event_name = 'purchase') AS money
FROM codes GROUP BY ALL
""")
# Every day with a code has a snapshot of its product.
fragment("fpc", """
SELECT product_id, campaign_id, price, discount_value, CAST(sum(n) AS BIGINT) AS total_events, CAST(sum(v) AS BIGINT) AS views,
  CAST(sum(c) AS BIGINT) AS checkouts, CAST(sum(b) AS BIGINT) AS purchases,
  CAST(coalesce(sum(money), 0) AS DECIMAL(18,2)) AS revenue, min(event_date) AS first_seen_date, max(event_date) AS last_seen_date
FROM code_days JOIN pday USING (product_id, event_date) GROUP BY product_id, campaign_id, price, discount_value
""")
fragment("pdaily", """
SELECT CAST(strftime(event_timestamp, '%Y%m%d') AS INTEGER) AS date_id, product_id,
  count(*) FILTER (event_name = 'view_item') AS views,
  count(*) FILTER (event_name = 'begin_checkout') AS checkouts,
  count(*) FILTER (event_name = 'purchase') AS purchases,
  CAST(sum(CASE WHEN event_name = 'purchase' THEN item_revenue ELSE 0 END) AS DECIMAL(18,2)) AS revenue
FROM stg WHERE product_id IS NOT NULL GROUP BY 1, 2
""")
# Order lines as product day snapshots.
fragment("lday", """
SELECT l_partkey, CAST(l_shipdate AS DATE) AS ship_day, disc FROM (
  SELECT l_partkey, l_shipdate, CAST(floor(l_discount * 20) AS INTEGER) AS disc,
    row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
      ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn FROM lineitem) WHERE rn = 1
""")
fragment("lver", """
SELECT l_partkey, disc, ship_day AS effective_start_date,
  lead(ship_day) OVER (PARTITION BY l_partkey ORDER BY ship_day) AS effective_end_date,
  lead(ship_day) OVER (PARTITION BY l_partkey ORDER BY ship_day) IS NULL AS is_active
FROM (SELECT *, lag(disc) OVER (PARTITION BY l_partkey ORDER BY ship_day) AS before,
        row_number() OVER (PARTITION BY l_partkey ORDER BY ship_day) AS nth FROM lday)
WHERE nth = 1 OR before IS DISTINCT FROM disc
""")
# Customers as users: a version from the first order on, another from the first order with priority 1 on.
fragment("udim", """
SELECT *, lead(effective_start_date) OVER (PARTITION BY user_id ORDER BY effective_start_date) AS effective_end_date
FROM (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, c_mktsegment AS customer_segment,
    CAST(c_nationkey AS VARCHAR) AS region, 'standard' AS risk_segment, CAST(min(o_orderdate) AS DATE) AS effective_start_date
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3
  UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), c_mktsegment, CAST(c_nationkey AS VARCHAR), 'urgent',
    CAST(min(o_orderdate) FILTER (o_orderpriority LIKE '1%') AS DATE) AS d
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3
  HAVING d > CAST(min(o_orderdate) AS DATE))
""")
