"""Staging to silver for one batch.

Every step is a function of (batch, committed state), written with replace semantics under the run's
sequence number; the checkpoint comes last. A run that dies anywhere is simply run again.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.columns import ntz, observed, utc_now
from tidemark.operators import attribution, facts, incremental, scd, sessions
from tidemark.operators.incremental import Bounds
from tidemark.options import Options
from tidemark.sources import lookups
from tidemark.sources.warehouse import Warehouse

SESSION_TABLES = (
    "silver_user_sessions",
    "silver_session_features",
    "silver_list_impressions",
    "silver_event_list_attribution",
    "silver_session_campaign_last_touch",
)


def run_silver(
    wh: Warehouse,
    options: Options = Options(),
    batch: DataFrame | None = None,
    run_ts: datetime | None = None,
    catalogs: dict[str, DataFrame] | None = None,
) -> dict:
    """Process new staged rows (or the given batch); returns the run's counts and the ``dates`` whose tables it changed.

    ``dates`` are the days of new facts and the start dates of recomputed sessions, for gold to rebuild. ``catalogs``
    give the attributes of campaigns and experiments seen for the first time: ``dim_campaigns`` or ``dim_experiments``
    -> a frame keyed by the id.
    """
    run_ts = run_ts or utc_now()
    done = wh.committed()
    seq = done + 1
    checkpoint = wh.table("etl_checkpoints", done)
    mark = checkpoint.first()
    last = Bounds(mark["hwm_ts"], mark["hwm_event_id"]) if mark else Bounds()
    reach = mark["max_session_days"] if mark else 0
    if batch is None:
        # Only ingestion days from the last mark on are listed and read.
        since = wh.dates_since("stg_events", "ingestion_date", last.last_ts and last.last_ts.date())
        recent = wh.table("stg_events", dates=since)
        bounds = incremental.fetch_bounds(incremental.hwm_bounds(recent, checkpoint))
        batch = incremental.current_batch(recent, bounds)
    else:
        bounds = _later(last, incremental.fetch_bounds(incremental.hwm_bounds(batch)))

    batch_days = days_of(batch.select(F.to_date("event_timestamp").alias("day")))
    known = wh.table("fct_events", done, dates=batch_days)
    # Counted while the rows are written, without passes of their own.
    read, kept = Observation("batch"), Observation("net_new")
    # No table after staging holds the raw line, most of a row's bytes: it is not sorted and shuffled with the rest.
    counted = batch.drop("raw_event").observe(read, F.count(F.lit(1)).alias("current_batch_rows"))
    fresh_rows = incremental.net_new(incremental.dedup_latest(counted), known, batch_days)
    new = cut(wh, fresh_rows.observe(kept, F.count(F.lit(1)).alias("net_new_rows")), "net_new", seq)
    counts = observed(read, "current_batch_rows") | observed(kept, "net_new_rows")
    dates: set = set()
    if counts["net_new_rows"]:
        platforms = lookups.dim_platforms(wh.spark, options.platforms)
        fresh = facts.fct_events(new, platforms, run_ts)
        *_, (reach, lost, session_dates) = together(
            wh.spark,
            lambda: _dimensions(wh, new, done, seq, catalogs or {}),
            lambda: wh.write_delta("fct_product_daily_performance", facts.product_daily(new), seq),
            lambda: wh.write_delta("product_campaign_days", facts.product_campaign_days(new), seq),
            lambda: _sessions(wh, fresh, options, run_ts, done, seq, reach),
        )
        wh.append_facts(fresh, seq)
        counts |= lost
        dates = session_dates | set(days_of(new.select(F.to_date("event_timestamp"))))
    row = incremental.advance(
        wh.spark, bounds, counts["current_batch_rows"], counts["net_new_rows"], run_ts, reach
    )
    wh.write_snapshot("etl_checkpoints", row, seq)
    wh.tidy(seq)
    return {"run_seq": seq, **counts, "dates": sorted(dates)}


def days_of(df: DataFrame) -> list:
    """Distinct dates of a one-column frame, at most one per calendar day, to prune partitions with."""
    return [r[0] for r in df.distinct().collect() if r[0] is not None]


def together(spark, *steps) -> list:
    """Run independent steps as concurrent Spark jobs; the first failure is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in running]


def _later(last: Bounds, upper: Bounds) -> Bounds:
    """A replayed batch never moves the mark back."""
    if upper.empty:
        return last
    if last.last_ts and (last.last_ts, last.last_id) > (upper.upper_ts, upper.upper_id):
        return Bounds(last.last_ts, last.last_id, last.last_ts, last.last_id)
    return Bounds(last.last_ts, last.last_id, upper.upper_ts, upper.upper_id)


def cut(wh: Warehouse, df: DataFrame, name: str, seq: int) -> DataFrame:
    """Write an intermediate that many steps read, and continue from the written table."""
    path = f"{wh.path('_work')}/run_seq={seq}/{name}"
    df.write.mode("overwrite").parquet(path)
    return wh.spark.read.schema(df.schema).parquet(path)


def _dimensions(wh: Warehouse, new: DataFrame, done: int, seq: int, catalogs: dict) -> None:
    def users():
        dim = wh.table("dim_users", done)
        wh.write_snapshot("dim_users", scd.merge_users(dim, scd.user_changes(new, dim)), seq)

    def products():
        wh.write_delta("product_days", scd.product_day(new), seq)
        touched = new.filter(F.col("product_id").isNotNull()).select("product_id").distinct()
        history = wh.table("product_days", seq).join(touched, "product_id", "left_semi")
        dim = wh.table("dim_products", done)
        kept = dim.join(touched, "product_id", "left_anti")
        rebuilt = scd.conform(scd.dim_products(history), dim.schema)
        wh.write_snapshot("dim_products", kept.select(*rebuilt.columns).unionByName(rebuilt), seq)

    def merged(name, merge, **more):
        return lambda: wh.write_snapshot(name, merge(wh.table(name, done), new, **more), seq)

    together(
        wh.spark,
        users,
        products,
        merged("dim_item_lists", scd.merge_item_lists),
        merged("dim_campaigns", scd.merge_campaigns, catalog=catalogs.get("dim_campaigns")),
        merged("dim_experiments", scd.merge_experiments, catalog=catalogs.get("dim_experiments")),
    )


def _sessions(
    wh, fresh: DataFrame, options: Options, run_ts, done: int, seq: int, reach: int
) -> tuple[int, dict, set]:
    """Recompute the sessions the batch reaches and replace the parts (session date, bucket of the actor) they lie in.

    Whatever is read and written follows the batch: stored sessions come from the parts its events can reach, facts from
    the days of the affected sessions. ``reach`` is the most days a stored session spans; returns the new value, how many
    events have no session, and the touched session dates.
    """
    minutes = options.session_minutes
    wh.check_buckets()
    lost = sessions.unsessionable_count(fresh).first().asDict()
    gap = F.expr(f"interval {minutes} minutes")
    ts = F.col("event_timestamp")
    reached = F.sequence(F.date_sub(F.to_date(ts - gap), reach), F.to_date(ts + gap))
    near_parts = parts_of(sessions.sessionizable(fresh), F.explode(reached), wh)
    if not near_parts:
        return reach, lost, set()
    near = wh.table("silver_user_sessions", done, parts=near_parts)
    affected = cut(wh, sessions.affected_sessions(near, fresh, minutes), "affected", seq)
    pool = cut(wh, sessions.events_window(fresh, _events_of(wh, affected, fresh, minutes, done)), "pool", seq)

    rollup = cut(wh, sessions.session_rollup(pool, minutes, options.cart_value_column), "rollup", seq)
    impressions = sessions.distinct_impressions(sessions.list_impressions(pool, minutes))
    attributed = attribution.list_attribution(attribution.last_touch(pool, minutes), minutes)
    touch = attribution.rollup_campaign_touch(rollup).withColumn("updated_at", ntz(run_ts))
    results = dict(
        zip(
            SESSION_TABLES,
            (
                sessions.rollup_sessions(rollup),
                sessions.rollup_features(rollup, options.high_value_threshold),
                impressions,
                attributed,
                touch,
            ),
        )
    )
    stale = affected.select(*sessions.SESSION).unionByName(rollup.select(*sessions.SESSION)).distinct()
    touched = parts_of(stale, F.to_date("session_start_ts"), wh)

    def replace(name):
        current = wh.table(name, done, parts=touched)
        kept = current.join(stale, sessions.SESSION, "left_anti").select(*current.columns)
        wh.write_parts(name, kept.unionByName(scd.conform(results[name], current.schema)), seq)

    together(wh.spark, *[partial(replace, name) for name in SESSION_TABLES])
    wh.list_parts(touched, done, seq)
    longest = rollup.agg(F.max(F.datediff("session_end_ts", "session_start_ts"))).first()[0]
    return max(reach, longest), lost, {d for d, _ in touched}


def parts_of(rows: DataFrame, day, wh: Warehouse) -> set:
    """Distinct (date, bucket of the actor): at most calendar days x buckets."""
    return {tuple(r) for r in rows.select(day.alias("day"), wh.bucket().alias("bucket")).distinct().collect()}


def _events_of(wh: Warehouse, affected: DataFrame, fresh: DataFrame, minutes: int, done: int) -> DataFrame:
    """Stored events of the affected sessions, without those the batch brings again."""
    stored = wh.table("fct_events", done, dates=days_of(session_days(affected)))
    return (
        sessions.within(stored, affected, minutes)
        .select(*stored.columns)
        .join(fresh.select("event_id"), "event_id", "left_anti")
        .select(*stored.columns)
    )


def session_days(found: DataFrame) -> DataFrame:
    """All days that the sessions lie on."""
    return found.select(
        F.explode(F.sequence(F.to_date("session_start_ts"), F.to_date("session_end_ts"), F.expr("interval 1 day")))
    )
