"""Slowly changing dimensions as rebuilt timelines.

A version is [effective_start_date, effective_end_date); an open version has no end and is active. Ends
are never edited in place: they are the next version's start. Windows run over versions or day snapshots
of one key, at most one per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import codes, is_event, surrogate

START, END, ACTIVE = "effective_start_date", "effective_end_date", "is_active"


def active(dim: DataFrame) -> DataFrame:
    return dim.filter(ACTIVE)


def close_intervals(versions: DataFrame, nk: str) -> DataFrame:
    """End date = next start of the key; the last version is open."""
    following = F.lead(START).over(Window.partitionBy(nk).orderBy(START))
    return versions.withColumn(END, following).withColumn(ACTIVE, F.col(END).isNull())


def timeline(days: DataFrame, nk: str, day: str, attrs: list) -> DataFrame:
    """Versions from day snapshots: a day opens a version when any attribute differs from the day before."""
    order = Window.partitionBy(nk).orderBy(day)
    changed = F.lag(day).over(order).isNull()
    for a in attrs:
        changed = changed | ~F.lag(a).over(order).eqNullSafe(F.col(a))
    points = days.withColumn("changed", changed).filter("changed")
    return close_intervals(points.select(nk, *attrs, F.col(day).alias(START)), nk)


def with_surrogate(dim: DataFrame, nk: str, name: str) -> DataFrame:
    return dim.withColumn(name, surrogate(nk, START))


def conform(df: DataFrame, schema) -> DataFrame:
    """Columns and types of ``schema``; columns not present become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def scd2_merge(dim: DataFrame, changes: DataFrame, nk: str, attrs: list, parts: int | None = None) -> DataFrame:
    """Versions of ``dim`` plus ``changes`` (nk, change_date, attrs).

    A change on a version's start date updates that version, otherwise it opens a new one and splits the
    interval it falls into; late changes end where the next version starts. NULL attributes of a change
    keep the old value. Other columns of ``dim`` carry over from the version before. ``parts`` is the number of
    partitions the keys are dealt to, which bounds a task's memory; by default the session's.
    """
    others = [c for c in dim.columns if c not in (nk, START, END, ACTIVE, *attrs)]
    old = dim.select(nk, START, *attrs, *others, F.lit(0).alias("prio"))
    new = changes.select(nk, F.col("change_date").alias(START), *attrs, F.lit(1).alias("prio"))
    rows = old.unionByName(new, allowMissingColumns=True)
    merged = (
        (rows.repartition(parts, nk) if parts else rows)
        .groupBy(nk, START)
        .agg(
            F.max("prio").alias("prio"),
            *[F.max_by(a, F.when(F.col(a).isNotNull(), F.col("prio"))).alias(a) for a in attrs],
            *[F.max(F.when(F.col("prio") == 0, F.col(o))).alias(o) for o in others],
        )
    )
    upto = Window.partitionBy(nk).orderBy(START).rowsBetween(Window.unboundedPreceding, 0)
    for o in others:
        merged = merged.withColumn(o, F.last(o, ignorenulls=True).over(upto))
    return close_intervals(merged.drop("prio"), nk).select(*dim.columns)


def versions_on(days: DataFrame, dim: DataFrame, nk: str, date: str) -> DataFrame:
    """Distinct (key, day) pairs with the dimension version valid on the day; days without one are left out.

    Versions and days lie on one line per key and the last version is carried forward, so the work is linear in both.
    A line holds at most two rows per calendar day.
    """
    version = F.struct(*[c for c in dim.columns if c != nk])
    starts = dim.filter(F.col(nk).isNotNull() & F.col(START).isNotNull()).select(
        nk, F.col(START).alias(date), version.alias("version")
    )
    asked = days.filter(F.col(nk).isNotNull() & F.col(date).isNotNull()).select(nk, date).distinct()
    line = starts.unionByName(asked.withColumn("version", F.lit(None)))
    order = Window.partitionBy(nk).orderBy(date, F.col("version").isNull())
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    carried = line.withColumn("valid", F.last("version", ignorenulls=True).over(upto))
    valid = carried.filter(F.col("version").isNull() & F.col("valid").isNotNull())
    ended = F.col(f"valid.{END}")
    return valid.filter(ended.isNull() | (F.col(date) < ended)).select(nk, date, "valid.*")


def as_of_join(facts: DataFrame, dim: DataFrame, nk: str, date: str, how: str = "inner") -> DataFrame:
    """Facts with the dimension version valid on their date.

    The version is settled once per distinct (key, day); fact rows then meet it on equality, so a busy key
    costs no version scan per row. Versions of one key do not overlap.
    """
    return facts.join(versions_on(facts, dim, nk, date), [nk, date], how)


def covers(day: Column, prefix: str = "") -> Column:
    start, end = F.col(prefix + START), F.col(prefix + END)
    return (start <= day) & (end.isNull() | (day < end))


# --- users -----------------------------------------------------------------------------------------


def user_changes(net_new: DataFrame, dim: DataFrame) -> DataFrame:
    """At most one change per user: new, first or earlier purchase, first instalment purchase."""
    day = F.to_date("event_timestamp")
    bought = is_event("purchase")
    seen = (
        net_new.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.min(day).alias("first_event"),
            F.min(F.when(bought, day)).alias("first_buy"),
            F.min(F.when(bought & (F.col("installments") > 0), day)).alias("first_installment"),
        )
    )
    current = active(dim).select("user_id", "first_purchase_date", "has_used_installments", F.lit(True).alias("known"))
    both = seen.join(current, "user_id", "left")
    is_new = F.col("known").isNull()
    earlier = F.col("first_purchase_date").isNull() | (F.col("first_buy") < F.col("first_purchase_date"))
    purchase_change = ~is_new & F.col("first_buy").isNotNull() & earlier
    installment_change = ~is_new & F.col("first_installment").isNotNull() & ~F.col("has_used_installments")
    change_date = F.when(is_new, F.col("first_event")).otherwise(
        F.least(
            F.when(purchase_change, F.col("first_buy")),
            F.when(installment_change, F.col("first_installment")),
        )
    )
    return both.select(
        "user_id",
        change_date.alias("change_date"),
        F.when(is_new | purchase_change, F.col("first_buy"))
        .otherwise(F.col("first_purchase_date"))
        .alias("first_purchase_date"),
        F.when(is_new, F.col("first_installment").isNotNull())
        .otherwise(F.col("has_used_installments") | installment_change)
        .alias("has_used_installments"),
    ).filter(F.col("change_date").isNotNull())


def merge_users(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """Users after the changes; the purchase date only moves back and the flag only turns on."""
    touched = dim.join(changes.select("user_id"), "user_id", "left_semi").select(*dim.columns)
    merged = scd2_merge(touched.drop("user_sk"), changes, "user_id", ["first_purchase_date", "has_used_installments"])
    upto = Window.partitionBy("user_id").orderBy(START).rowsBetween(Window.unboundedPreceding, 0)
    merged = merged.withColumn("first_purchase_date", F.min("first_purchase_date").over(upto)).withColumn(
        "has_used_installments", F.coalesce(F.bool_or("has_used_installments").over(upto), F.lit(False))
    )
    kept = dim.join(changes.select("user_id"), "user_id", "left_anti")
    fresh = with_surrogate(merged, "user_id", "user_sk")
    return kept.select(*dim.columns).unionByName(fresh.select(*dim.columns))


# --- products --------------------------------------------------------------------------------------


def product_day(net_new: DataFrame) -> DataFrame:
    """Last name and price of each product on each day."""
    last = F.max(
        F.struct(
            "event_timestamp", "event_id", "product_name", F.col("total_price").cast("decimal(12,2)").alias("price")
        )
    )
    return (
        net_new.filter(F.col("product_id").isNotNull())
        .groupBy("product_id", F.to_date("event_timestamp").alias("event_date"))
        .agg(last.alias("last"))
        .select(
            "product_id",
            "event_date",
            "last.product_name",
            "last.price",
            F.col("last.event_timestamp").alias("last_ts"),
            F.col("last.event_id").alias("last_event_id"),
        )
    )


def merge_product_days(state: DataFrame, days: DataFrame) -> DataFrame:
    """Day snapshots after a batch: the later observation of a day wins."""
    best = F.max(F.struct("last_ts", "last_event_id", "product_name", "price")).alias("best")
    return (
        state.unionByName(days.select(*state.columns))
        .groupBy("product_id", "event_date")
        .agg(best)
        .select(
            "product_id", "event_date", "best.product_name", "best.price", "best.last_ts", "best.last_event_id"
        )
    )


def product_changes(days: DataFrame, dim: DataFrame) -> DataFrame:
    """Days whose name or price differs from the day before, the first one against the active version."""
    order = Window.partitionBy("product_id").orderBy("event_date")
    current = active(dim).select(
        "product_id", F.col("product_name").alias("dim_name"), F.col("price").alias("dim_price"),
        F.lit(True).alias("known"),
    )
    both = days.join(current, "product_id", "left")
    first = F.lag("event_date").over(order).isNull()
    before_name = F.when(first, F.col("dim_name")).otherwise(F.lag("product_name").over(order))
    before_price = F.when(first, F.col("dim_price")).otherwise(F.lag("price").over(order))
    differs = ~before_name.eqNullSafe(F.col("product_name")) | ~before_price.eqNullSafe(F.col("price"))
    return (
        both.withColumn("changed", (first & F.col("known").isNull()) | differs)
        .filter("changed")
        .select("product_id", F.col("event_date").alias("change_date"), "product_name", "price")
    )


def dim_products(days: DataFrame) -> DataFrame:
    return with_surrogate(
        timeline(days, "product_id", "event_date", ["product_name", "price"]), "product_id", "product_sk"
    )


# --- insert if unseen ------------------------------------------------------------------------------


def first_seen(df: DataFrame, nk: str) -> DataFrame:
    return (
        df.filter(F.col(nk).isNotNull())
        .groupBy(nk)
        .agg(F.min(F.to_date("event_timestamp")).alias("first_date"))
    )


def scd_insert_unseen(dim: DataFrame, seen: DataFrame, nk: str, names: dict | None = None) -> DataFrame:
    """One open version per key the dimension has no active row for; ``names`` maps columns to values.

    A key that late events show on an earlier day starts on that day, so the order of batches does not matter.
    """
    late = seen.select(nk, F.col("first_date").alias("late_date"))
    start = F.when(F.col(ACTIVE), F.least(START, F.coalesce("late_date", START))).otherwise(F.col(START))
    known = dim.join(late, nk, "left").withColumn(START, start).select(*dim.columns)
    unseen = seen.join(active(dim).select(nk), nk, "left_anti")
    rows = unseen.select(
        *seen.columns,
        F.col("first_date").alias(START),
        F.lit(None).cast("date").alias(END),
        F.lit(True).alias(ACTIVE),
    )
    for name, value in (names or {}).items():
        rows = rows.withColumn(name, value)
    sk = [c for c in dim.columns if c.endswith("_sk")]
    for c in sk:
        rows = with_surrogate(rows, nk, c)
    return known.unionByName(conform(rows, dim.schema))


def latest_names(net_new: DataFrame, nk: str, name: str) -> DataFrame:
    return (
        net_new.filter(F.col(nk).isNotNull() & F.col(name).isNotNull())
        .groupBy(nk)
        .agg(F.max_by(name, F.struct("event_timestamp", "event_id")).alias(name))
    )


def scd1_refresh(dim: DataFrame, latest: DataFrame, nk: str, name: str) -> DataFrame:
    """Active rows take the latest name; history keeps its own."""
    fresh = latest.select(nk, F.col(name).alias("fresh_name"))
    renamed = F.when(F.col(ACTIVE), F.coalesce("fresh_name", name)).otherwise(F.col(name))
    return dim.join(fresh, nk, "left").withColumn(name, renamed).select(*dim.columns)


def merge_item_lists(dim: DataFrame, net_new: DataFrame) -> DataFrame:
    names = latest_names(net_new, "item_list_id", "item_list_name")
    seen = first_seen(net_new, "item_list_id").withColumn("item_list_name", F.col("item_list_id"))
    return scd1_refresh(scd_insert_unseen(dim, seen, "item_list_id"), names, "item_list_id", "item_list_name")


def campaign_rows(df: DataFrame, codes_col: str = "discount_campaigns") -> DataFrame:
    """One row per event and campaign code."""
    return df.withColumn("campaign_id", F.explode(codes(codes_col)))


def _with_catalog(rows: DataFrame, catalog: DataFrame | None, nk: str) -> DataFrame:
    return rows if catalog is None else rows.join(catalog, nk, "left")


def merge_campaigns(dim: DataFrame, net_new: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    # Collapse to (codes, day) before exploding.
    days = net_new.filter(F.col("discount_campaigns").isNotNull()).groupBy(
        "discount_campaigns", F.to_date("event_timestamp").alias("event_timestamp")
    ).count()
    seen = _with_catalog(first_seen(campaign_rows(days), "campaign_id"), catalog, "campaign_id")
    names = {} if "campaign_name" in seen.columns else {"campaign_name": F.col("campaign_id")}
    return scd_insert_unseen(dim, seen, "campaign_id", names)


def merge_experiments(dim: DataFrame, net_new: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    rows = net_new.select(F.col("discount_experiment_variant").alias("experiment_id"), "event_timestamp")
    seen = _with_catalog(first_seen(rows, "experiment_id"), catalog, "experiment_id")
    names = {
        c: F.col("experiment_id")
        for c in ("experiment_name", "variant_name")
        if c not in seen.columns
    }
    return scd_insert_unseen(dim, seen, "experiment_id", names)
