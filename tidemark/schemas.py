"""Table schemas. Timestamps carry no zone and hold UTC."""

from __future__ import annotations

import re

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
    **{f"decimal({p},{s})": T.DecimalType(p, s) for p, s in ((10, 2), (12, 2), (12, 6), (18, 2))},
}


def _ddl(text: str) -> T.StructType:
    """``name type, ...`` without a session (``StructType.fromDDL`` needs one)."""
    pairs = (column.split() for column in re.split(r",(?!\d)", text))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


STG_EVENTS = _ddl(
    "event_id string, event_name string, event_timestamp timestamp_ntz, replay_timestamp timestamp_ntz,"
    "user_id string, platform string, item_list_id string, item_list_name string,"
    "product_id string, product_name string, price_in_usd decimal(12,6), price decimal(12,2),"
    "quantity int, item_revenue_in_usd decimal(12,6), item_revenue decimal(12,2),"
    "discount_value decimal(10,2), total_price decimal(10,2), discount_campaigns string,"
    "discount_experiment_variant string, installments int, installment_price decimal(10,2),"
    "is_in_stock boolean, raw_event string, ingestion_timestamp timestamp_ntz"
)

FCT_EVENTS = _ddl(
    "event_id string, event_timestamp timestamp_ntz, event_name string, user_id string,"
    "product_id string, item_list_id string, platform_id int, date_id date, campaign_codes string,"
    "experiment_id string, price_in_usd decimal(12,6), price decimal(12,2), quantity int,"
    "item_revenue_in_usd decimal(12,6), item_revenue decimal(12,2), discount_value decimal(10,2),"
    "total_price decimal(10,2), installments int, installment_price decimal(10,2),"
    "is_in_stock boolean, ingestion_timestamp timestamp_ntz, updated_at timestamp_ntz"
)

_VALIDITY = "effective_start_date date, effective_end_date date, is_active boolean"
_TARGETING = "targeting_source string, targeting_segment string, targeting_risk_segment string"
_PLANNED = "planned_start_date date, planned_end_date date"

DIM_USERS = _ddl(
    "user_sk long, user_id string, source string, region string, customer_segment string,"
    "risk_segment string, credit_available decimal(12,2), first_purchase_date date,"
    f"has_used_installments boolean, {_VALIDITY}"
)
DIM_PRODUCTS = _ddl(
    "product_sk long, product_id string, product_name string, product_category string,"
    f"price decimal(12,2), {_VALIDITY}"
)
DIM_ITEM_LISTS = _ddl(
    "item_list_sk long, item_list_id string, item_list_name string, list_type string,"
    "targeting_customer_segment string, targeting_region string, associated_experiment_variant string,"
    f"{_PLANNED}, {_VALIDITY}"
)
DIM_CAMPAIGNS = _ddl(
    f"campaign_sk long, campaign_id string, campaign_name string, {_TARGETING}, {_PLANNED}, {_VALIDITY}"
)
DIM_EXPERIMENTS = _ddl(
    "experiment_sk long, experiment_id string, experiment_name string, variant_name string,"
    f"{_TARGETING}, {_PLANNED}, {_VALIDITY}"
)

# Day snapshots behind dim_products: versions alone forget "still the same on day d".
PRODUCT_DAYS = _ddl(
    "product_id string, event_date date, product_name string, price decimal(12,2),"
    "last_ts timestamp_ntz, last_event_id string"
)

USER_SESSIONS = _ddl(
    "user_id string, platform_id int, session_start_ts timestamp_ntz, session_end_ts timestamp_ntz,"
    "session_date date, events_in_session int, views int, checkouts int, purchases int"
)
SESSION_FEATURES = _ddl(
    "user_id string, platform_id int, session_start_ts timestamp_ntz, session_end_ts timestamp_ntz,"
    "session_date date, events_in_session int, had_view boolean, had_checkout boolean,"
    "had_purchase boolean, is_bounce boolean, is_abandoned_checkout boolean,"
    "cart_value decimal(12,2), cart_products array<string>, is_high_value_abandoned_checkout boolean"
)
LIST_IMPRESSIONS = _ddl(
    "user_id string, platform_id int, session_id string, session_start_ts timestamp_ntz,"
    "session_date date, item_list_id string, impression_ts timestamp_ntz, date_id date"
)
LIST_ATTRIBUTION = _ddl(
    "event_id string, user_id string, event_name string, event_timestamp timestamp_ntz,"
    "item_list_id string, platform_id int, session_id string, session_start_ts timestamp_ntz,"
    "impression_ts_chosen timestamp_ntz, attribution_model string, window_minutes int,"
    "attribution_version int, date_id date, item_revenue_in_usd decimal(12,6), installments int,"
    "session_date date"
)
CAMPAIGN_TOUCH = _ddl(
    "user_id string, platform_id int, session_id string, session_start_ts timestamp_ntz,"
    "campaign_id string, last_touch_ts timestamp_ntz, updated_at timestamp_ntz, session_date date"
)
PRODUCT_DAILY = _ddl(
    "date_id int, product_id string, views long, checkouts long, purchases long, revenue decimal(18,2)"
)
PRODUCT_CAMPAIGNS = _ddl(
    "product_id string, campaign_id string, price decimal(12,2), discount_value decimal(10,2),"
    "total_events long, views long, checkouts long, purchases long, revenue decimal(18,2),"
    "first_seen_date date, last_seen_date date"
)
PRODUCT_CAMPAIGN_DAYS = _ddl(
    "product_id string, campaign_id string, day date, discount_value decimal(10,2), total_events long, views long,"
    "checkouts long, purchases long, revenue decimal(18,2)"
)
CHECKPOINTS = _ddl(
    "pipeline string, hwm_ts timestamp_ntz, hwm_event_id string, last_run_current_batch_rows long,"
    "last_run_net_new_rows long, updated_at timestamp_ntz, max_session_days int"
)
# Which run holds a part of a session table.
SESSION_PARTS = _ddl("table string, session_date date, bucket int, seq int, buckets int")
