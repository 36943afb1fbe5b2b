"""Gap sessions per (user, platform).

Two events less than the session gap apart are always in the same session, so all events of one
(user, platform, cell) with a cell no wider than the gap share a session. Sessions are therefore found on
cells, not on events: events collapse map-side into cells, and the window over a user's cells is bounded
by the time span over the gap, however many events the user has. Session aggregates come from cell
aggregates without ever moving event rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import codes, is_event, session_key, time_bucket

ACTOR = ["user_id", "platform_id"]
SESSION = [*ACTOR, "session_start_ts"]
IMPRESSION = "view_item_list"


def sessionizable(facts: DataFrame) -> DataFrame:
    """Events with a known actor; the others stay in the facts but have no session."""
    return facts.filter(
        F.col("user_id").isNotNull()
        & F.col("platform_id").isNotNull()
        & F.col("event_timestamp").isNotNull()
    )


def unsessionable_count(facts: DataFrame) -> DataFrame:
    """How many events have no session, per reason."""
    return facts.agg(
        F.count_if(F.col("user_id").isNull()).alias("no_user"),
        F.count_if(F.col("user_id").isNotNull() & F.col("platform_id").isNull()).alias("no_platform"),
    )


def with_cell(facts: DataFrame, minutes: int) -> DataFrame:
    return facts.withColumn("cell", time_bucket("event_timestamp", minutes * 60))


def session_cells(facts: DataFrame, minutes: int, *aggs: Column) -> DataFrame:
    return (
        with_cell(sessionizable(facts), minutes)
        .groupBy(*ACTOR, "cell")
        .agg(
            F.min("event_timestamp").alias("cell_start"),
            F.max("event_timestamp").alias("cell_end"),
            *aggs,
        )
    )


def session_islands(cells: DataFrame, minutes: int) -> DataFrame:
    """Adds ``session_start_ts``: a cell opens a session when the pause before it exceeds the gap."""
    order = Window.partitionBy(*ACTOR).orderBy("cell")
    previous_end = F.lag("cell_end").over(order)
    opens = previous_end.isNull() | (
        F.col("cell_start") - previous_end > F.expr(f"interval {minutes} minutes")
    )
    return cells.withColumn("opened", F.when(opens, F.col("cell_start"))).withColumn(
        "session_start_ts",
        F.last("opened", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    ).drop("opened")


def attach_sessions(rows: DataFrame, islands: DataFrame, minutes: int) -> DataFrame:
    """Rows plus session start, date and id. The join key holds the cell, so a busy user spreads out."""
    found = with_cell(sessionizable(rows), minutes).join(
        islands.select(*ACTOR, "cell", "session_start_ts"), [*ACTOR, "cell"]
    )
    return name_sessions(found.drop("cell"))


def name_sessions(df: DataFrame) -> DataFrame:
    return df.withColumn("session_date", F.to_date("session_start_ts")).withColumn(
        "session_id", session_key("user_id", "platform_id", "session_start_ts")
    )


def sessionize(facts: DataFrame, minutes: int = 30, rows: DataFrame | None = None) -> DataFrame:
    """``rows`` (default: all facts) labelled with the sessions of ``facts``."""
    islands = session_islands(session_cells(facts, minutes), minutes)
    return attach_sessions(facts if rows is None else rows, islands, minutes)


def event_counts() -> list:
    return [
        F.count(F.lit(1)).alias("events_in_session"),
        F.count_if(is_event("view_item")).alias("views"),
        F.count_if(is_event("begin_checkout")).alias("checkouts"),
        F.count_if(is_event("purchase")).alias("purchases"),
    ]


def user_sessions(sessionized: DataFrame) -> DataFrame:
    """Sessions from labelled events."""
    counts = [c.cast("int").alias(n) for c, n in zip(event_counts(), COUNTS)]
    return (
        sessionized.groupBy(*SESSION)
        .agg(F.max("event_timestamp").alias("session_end_ts"), *counts)
        .withColumn("session_date", F.to_date("session_start_ts"))
        .select(*SESSION, "session_end_ts", "session_date", *COUNTS)
    )


COUNTS = ["events_in_session", "views", "checkouts", "purchases"]


def _line_value(value_col: str) -> Column:
    return F.when(is_event("begin_checkout"), F.col(value_col) * F.col("quantity"))


def within(rows: DataFrame, sessions: DataFrame, minutes: int) -> DataFrame:
    """Rows with the session (start and end) of their actor that they lie in.

    Sessions are spread over the cells they cover, so the join is an equality on (user, platform, cell) with at most two
    sessions a side; the time bounds only settle which.
    """
    width = minutes * 60
    spans = sessions.select(
        *SESSION,
        "session_end_ts",
        F.explode(
            F.sequence(time_bucket("session_start_ts", width), time_bucket("session_end_ts", width))
        ).alias("cell"),
    )
    met = with_cell(rows, minutes).join(spans, [*ACTOR, "cell"])
    return met.filter(F.col("event_timestamp").between(F.col("session_start_ts"), F.col("session_end_ts"))).drop("cell")


def cart_metrics(
    sessions: DataFrame, facts: DataFrame, minutes: int = 30, value_col: str = "price"
) -> DataFrame:
    """Cart value and products of the checkout lines inside each session."""
    lines = facts.filter(is_event("begin_checkout")).select(
        *ACTOR, "event_timestamp", "product_id", _line_value(value_col).alias("line")
    )
    return (
        within(lines, sessions, minutes)
        .groupBy(*SESSION)
        .agg(
            F.sum("line").cast("decimal(18,2)").alias("cart_value"),
            F.sort_array(F.collect_set("product_id")).alias("cart_products"),
        )
    )


def _features(df: DataFrame, threshold: float) -> DataFrame:
    abandoned = (F.col("checkouts") > 0) & (F.col("purchases") == 0)
    value = F.coalesce(F.col("cart_value"), F.lit(0).cast("decimal(18,2)"))
    return df.select(
        *SESSION,
        "session_end_ts",
        F.to_date("session_start_ts").alias("session_date"),
        F.col("events_in_session").cast("int").alias("events_in_session"),
        (F.col("views") > 0).alias("had_view"),
        (F.col("checkouts") > 0).alias("had_checkout"),
        (F.col("purchases") > 0).alias("had_purchase"),
        (F.col("events_in_session") == 1).alias("is_bounce"),
        abandoned.alias("is_abandoned_checkout"),
        value.alias("cart_value"),
        "cart_products",
        (abandoned & (value > F.lit(threshold))).alias("is_high_value_abandoned_checkout"),
    )


def session_features(sessions: DataFrame, cart: DataFrame, threshold: float = 500) -> DataFrame:
    return _features(sessions.join(cart, SESSION, "left"), threshold)


def session_rollup(facts: DataFrame, minutes: int = 30, value_col: str = "price") -> DataFrame:
    """Counts, bounds, cart and last campaign of every session in one pass over the facts.

    Cells are spread over their cart products and collapse to (session, product) before a session's list is made: no
    list holds a product twice, however many cells a session has. A cell's measures go with its first product.
    """
    checkout_product = F.when(is_event("begin_checkout"), F.col("product_id"))
    cells = session_cells(
        facts,
        minutes,
        *event_counts(),
        F.sum(_line_value(value_col)).cast("decimal(18,2)").alias("cart_value"),
        F.collect_set(checkout_product).alias("cart_products"),
        F.max(campaign_mark()).alias("touch"),
    )
    spread = session_islands(cells, minutes).select("*", F.posexplode_outer("cart_products").alias("nth", "product"))
    once = F.coalesce("nth", F.lit(0)) == 0
    measures = [*COUNTS, "cart_value"]
    by_product = spread.groupBy(*SESSION, "product").agg(
        F.max("cell_end").alias("session_end_ts"),
        *[F.sum(F.when(once, F.col(c))).alias(c) for c in measures],
        F.max("touch").alias("touch"),
    )
    products = F.sort_array(F.collect_list("product"))
    return by_product.groupBy(*SESSION).agg(
        F.max("session_end_ts").alias("session_end_ts"),
        *[F.sum(c).alias(c) for c in COUNTS],
        F.sum("cart_value").cast("decimal(18,2)").alias("cart_value"),
        F.when(F.sum("checkouts") > 0, products).alias("cart_products"),
        F.max("touch").alias("touch"),
    )


def campaign_mark() -> Column:
    """(time, event, campaign) of a campaign touch; inside one event the greatest code wins."""
    touched = codes("campaign_codes")
    return F.when(
        F.size(touched) > 0,
        F.struct(
            F.col("event_timestamp").alias("ts"),
            F.col("event_id").alias("event_id"),
            F.array_max(touched).alias("campaign_id"),
        ),
    )


def rollup_sessions(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        *SESSION,
        "session_end_ts",
        F.to_date("session_start_ts").alias("session_date"),
        *[F.col(c).cast("int").alias(c) for c in COUNTS],
    )


def rollup_features(rollup: DataFrame, threshold: float = 500) -> DataFrame:
    return _features(rollup, threshold)


def list_impressions(facts: DataFrame, minutes: int = 30) -> DataFrame:
    """Every list view with its session, keyed by event."""
    views = facts.filter(is_event(IMPRESSION) & F.col("item_list_id").isNotNull()).select(
        "event_id", *ACTOR, "item_list_id", "event_timestamp"
    )
    return sessionize(facts, minutes, rows=views).withColumnRenamed("event_timestamp", "impression_ts")


def distinct_impressions(impressions: DataFrame) -> DataFrame:
    return impressions.select(
        *ACTOR,
        "session_id",
        "session_start_ts",
        "session_date",
        "item_list_id",
        "impression_ts",
        F.to_date("impression_ts").alias("date_id"),
    ).distinct()


# --- incremental -----------------------------------------------------------------------------------


def impacted(net_new: DataFrame) -> DataFrame:
    return sessionizable(net_new).select(*ACTOR).distinct()


def affected_sessions(sessions: DataFrame, net_new: DataFrame, minutes: int = 30) -> DataFrame:
    """Stored sessions a batch extends, bridges or falls into.

    Stored sessions and the batch's cells are intervals on one line per actor; an interval opens a new
    group when it starts more than the gap after everything before it ended. A stored session is affected
    when its group holds a batch cell. Linear in sessions plus cells, no pairing of the two.
    """
    old = sessions.join(impacted(net_new), ACTOR, "left_semi").select(
        *ACTOR,
        F.col("session_start_ts").alias("lo"),
        F.col("session_end_ts").alias("hi"),
        F.lit(False).alias("is_batch"),
    )
    new = session_cells(net_new, minutes).select(
        *ACTOR, F.col("cell_start").alias("lo"), F.col("cell_end").alias("hi"), F.lit(True).alias("is_batch")
    )
    order = Window.partitionBy(*ACTOR).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = reach.isNull() | (F.col("lo") - reach > F.expr(f"interval {minutes} minutes"))
    groups = (
        old.unionByName(new)
        .withColumn("opened", F.when(opens, F.col("lo")))
        .withColumn(
            "group_start",
            F.last("opened", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        )
    )
    whole = Window.partitionBy(*ACTOR, "group_start")
    return (
        groups.withColumn("touched", F.bool_or("is_batch").over(whole))
        .filter(F.col("touched") & ~F.col("is_batch"))
        .select(*ACTOR, F.col("lo").alias("session_start_ts"), F.col("hi").alias("session_end_ts"))
    )


def prehistory(sessionized: DataFrame, affected: DataFrame, net_new: DataFrame) -> DataFrame:
    """Stored events of the affected sessions that the batch does not bring again."""
    return sessionized.join(affected.select(*SESSION), SESSION, "left_semi").join(
        net_new.select("event_id"), "event_id", "left_anti"
    )


def events_window(net_new: DataFrame, prior: DataFrame) -> DataFrame:
    columns = [c for c in net_new.columns if c in prior.columns]
    return net_new.select(*columns).unionByName(prior.select(*columns))


def merge_sessionized(
    state: DataFrame, sessions: DataFrame, net_new: DataFrame, minutes: int = 30
) -> DataFrame:
    """New labelled events: untouched sessions as they were, the affected ones labelled afresh."""
    affected = affected_sessions(sessions, net_new, minutes)
    pool = events_window(net_new, prehistory(state, affected, net_new))
    kept = state.join(affected.select(*SESSION), SESSION, "left_anti")
    fresh = sessionize(pool, minutes)
    return kept.select(*fresh.columns).unionByName(fresh)
