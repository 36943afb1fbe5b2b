"""Gold tables over a warehouse, and their materialisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import facts, gold, metrics
from tidemark.operators.sessions import within
from tidemark.options import Options
from tidemark.plans.silver import days_of, session_days
from tidemark.sources.warehouse import Warehouse, drop_partitions, replace_partitions

#: Tables with a row's date, which a change of that date's silver rows alone can change: name -> date column.
DAILY = {
    "engagement_daily": "date",
    "list_daily": "date",
    "platform_daily": "date",
    "campaign_daily": "date",
    "finance_daily": "event_date",
    "abandoned_cart_value": "session_date",
    "discounts_daily": "date_id",
    "installment_adoption": "date_id",
}


def daily_gold(wh: Warehouse, options: Options = Options(), dates: list | None = None) -> dict[str, DataFrame]:
    """The daily tables, lazy; with ``dates`` only those days, from the silver parts of those days alone."""
    done = wh.committed()
    parts = dates and {(d, b) for _, d, b, _ in wh.session_parts(done) if d in set(dates)}

    def t(name):
        return wh.table(name, done) if dates is None else wh.table(name, done, parts=parts)

    features, stored = t("silver_session_features"), t("silver_user_sessions")
    impressions, attributed = t("silver_list_impressions"), t("silver_event_list_attribution")
    touch = t("silver_session_campaign_last_touch")
    events = wh.table("fct_events", done, dates=dates)
    bought = facts.purchases(events)
    # A session's purchases may lie on a later day than its start.
    during = None if dates is None else days_of(session_days(stored))
    in_session = within(facts.purchases(wh.table("fct_events", done, dates=during)), stored, options.session_minutes)
    return {
        "engagement_daily": gold.engagement_daily(impressions, attributed, touch),
        "list_daily": gold.list_daily(impressions, attributed),
        "platform_daily": metrics.platform_daily(features, bought),
        "campaign_daily": metrics.campaign_daily(stored, touch, metrics.session_revenue(in_session)),
        "finance_daily": gold.finance_daily(bought, wh.table("dim_users", done)),
        "abandoned_cart_value": metrics.abandoned_cart_value(features),
        "discounts_daily": metrics.discounts_daily(events),
        "installment_adoption": metrics.installment_adoption(events),
    }


def run_gold(wh: Warehouse, as_of_date, register: bool = False, options: Options = Options()) -> dict[str, DataFrame]:
    """All gold tables as lazy DataFrames; nothing runs until one is read.

    ``register`` also creates a temporary view of each name.
    """
    t = wh.table
    features = t("silver_session_features")
    events = t("fct_events")
    bought = facts.purchases(events)
    dims = (t("dim_products"), t("dim_campaigns"), t("fct_product_campaigns"))
    out = daily_gold(wh, options) | {
        "price_change_events": gold.price_change_events(*dims),
        "current_status": gold.current_status(*dims, as_of_date),
        "product_metrics": gold.product_metrics(t("fct_product_daily_performance")),
        "segment_abandon_then_bought_different": gold.abandon_then_bought_different(features, bought),
        "dropped_without_purchase": metrics.dropped_without_purchase(features, bought),
        "experiment_order_value": metrics.experiment_order_value(events),
        "coupon_order_value": metrics.coupon_order_value(events),
        "user_features": metrics.user_features(events),
    }
    for name in gold.SEGMENTS:
        out[f"segment_{name}"] = gold.segment(features, name)
    if register:
        for name, df in out.items():
            df.createOrReplaceTempView(name)
    return out


def materialize(df: DataFrame, path: str, date_col: str, dates: list | None = None) -> None:
    """Replace the dates present in ``df`` and leave all others as they are.

    ``dates``, if given, are the dates ``df`` was computed for: those without rows are deleted.
    """
    replace_partitions(df, path, [date_col])
    if dates:
        present = {str(r[0]) for r in df.select(date_col).distinct().collect()}
        drop_partitions(df.sparkSession, path, date_col, [d for d in dates if str(d) not in present])


def refresh_gold(wh: Warehouse, root: str, dates: list | None = None, options: Options = Options()) -> None:
    """Rebuild the daily tables under ``root`` for the ``dates`` that a silver run returned; all dates by default."""
    if dates is not None and not dates:
        return
    for name, df in daily_gold(wh, options, dates).items():
        column = DAILY[name]
        rows = df.filter(F.col(column).isNotNull())
        if dates is not None:
            rows = rows.filter(F.col(column).isin(list(dates)))
        materialize(rows, f"{root}/{name}", column, dates)
