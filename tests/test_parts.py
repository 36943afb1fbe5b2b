"""What a run reads and writes: parts of session tables, commits, gold dates, backfilled loads."""

import json
from collections import Counter
from datetime import timedelta
from pathlib import Path

import pytest
from conftest import BASE, Shop, content, event
from test_incremental import random_rows, run_in

from tidemark.operators.backfill import backfill
from tidemark.options import Options
from tidemark.plans import silver
from tidemark.plans.backfill import run_backfill, staged
from tidemark.plans.gold import DAILY, daily_gold, refresh_gold, run_gold
from tidemark.plans.silver import run_silver
from tidemark.sources import warehouse
from tidemark.sources.warehouse import BUCKETED, Warehouse

DAY = 1440


def parts(wh):
    return {(n, d, b): seq for n, d, b, seq in wh.session_parts()}


def loaded(spark, root, users=40, days=5):
    """A warehouse of many users and days."""
    shop = Shop(spark, root)
    shop.wh = Warehouse(spark, root, session_buckets=8)
    rows = [event(f"e{d}-{u}", "view_item", d * DAY + u, f"u{u}") for d in range(days) for u in range(users)]
    shop.load(rows)
    run_silver(shop.wh)
    return shop


def test_a_late_event_rewrites_one_part_of_one_date(spark, tmp_path):
    shop = loaded(spark, str(tmp_path / "wh"))
    before = parts(shop.wh)
    assert len({(d, b) for _, d, b in before}) > 20
    late = event("late", "view_item", DAY + 3 + 10, "u3", ingestion_timestamp=BASE + timedelta(days=9))
    shop.load([late])
    counts = run_silver(shop.wh)
    assert counts["dates"] == [(BASE + timedelta(days=1)).date()]
    after = parts(shop.wh)
    assert set(after) == set(before)
    moved = {k for k in after if after[k] != before[k]}
    assert len({(d, b) for _, d, b in moved}) == 1 and {d for _, d, _ in moved} == {(BASE + timedelta(days=1)).date()}
    session = shop.wh.table("silver_user_sessions").filter("user_id = 'u3' AND events_in_session = 2").collect()
    assert len(session) == 1
    # Files of the second run lie in that part alone.
    written = {p.parent.relative_to(tmp_path) for p in Path(tmp_path).rglob("run_seq=2/session_date=*/bucket=*/*.parquet")}
    assert len({p.parts[-2:] for p in written}) == 1


def test_a_run_that_dies_between_two_tables_shows_the_old_ones(spark, tmp_path, monkeypatch):
    shop = loaded(spark, str(tmp_path / "wh"), users=6, days=2)
    before = {t: content(shop.wh.table(t)) for t in BUCKETED}
    write = Warehouse.write_parts

    def failing(self, name, df, seq):
        if name == "silver_list_impressions":
            raise RuntimeError("lost")
        write(self, name, df, seq)

    shop.load([event("late", "view_item", 20, "u3", ingestion_timestamp=BASE + timedelta(days=9))])
    monkeypatch.setattr(Warehouse, "write_parts", failing)
    with pytest.raises(RuntimeError):
        run_silver(shop.wh)
    assert before == {t: content(shop.wh.table(t)) for t in BUCKETED}
    monkeypatch.setattr(Warehouse, "write_parts", write)
    run_silver(shop.wh)
    assert shop.wh.table("silver_user_sessions").filter("user_id = 'u3' AND events_in_session = 2").count() == 1
    # The commit before is still there to be read.
    assert before["silver_user_sessions"] == content(shop.wh.table("silver_user_sessions", 1))


def test_old_parts_are_dropped_and_kept_commits_can_be_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse, "KEEP_SNAPSHOTS", 2)
    shop = loaded(spark, str(tmp_path / "wh"), users=3, days=1)
    for n in range(3):
        shop.load([event(f"l{n}", "view_item", 30 + n, "u1", ingestion_timestamp=BASE + timedelta(days=9 + n))])
        run_silver(shop.wh)
    files = {str(p) for p in Path(tmp_path).rglob("silver_user_sessions/run_seq=*/session_date=*/bucket=*")}
    assert {f.split("run_seq=")[1][0] for f in files} == {"1", "3", "4"}
    for commit in (3, 4):
        assert shop.wh.table("silver_user_sessions", commit).count() == 3
        assert shop.wh.table("silver_user_sessions", commit).agg({"events_in_session": "sum"}).first()[0] == 3 + commit - 1


def test_the_number_of_buckets_stays(spark, tmp_path):
    shop = loaded(spark, str(tmp_path / "wh"), users=2, days=1)
    shop.wh.session_buckets = 2
    shop.load([event("x", "view_item", 30, "u1", ingestion_timestamp=BASE + timedelta(days=9))])
    with pytest.raises(ValueError):
        run_silver(shop.wh)


def files_of(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("*.parquet")}


def test_gold_of_the_changed_dates_alone(spark, tmp_path):
    options = Options()
    shop, root = Shop(spark, str(tmp_path / "wh")), str(tmp_path / "gold")
    rows = random_rows(11, 120)
    run_in(shop, [rows])
    refresh_gold(shop.wh, root)
    before = files_of(root)
    assert {f.split("/")[0] for f in before} == set(DAILY)
    late = event("zz", "purchase", 1500, "u1", "IOS", product="P1", revenue=40, installments=2, discount_campaigns="C1|C2",
                 ingestion_timestamp=BASE + timedelta(days=30))
    shop.load([late])
    counts = run_silver(shop.wh)
    refresh_gold(shop.wh, root, counts["dates"])
    changed = {f.split("/")[1].split("=")[1] for f in before ^ files_of(root)}
    assert changed and changed <= {str(d) for d in counts["dates"]}
    whole = daily_gold(shop.wh, options)
    for name, column in DAILY.items():
        stored = spark.read.parquet(f"{root}/{name}").select(*whole[name].columns)
        assert content(stored) == content(whole[name].filter(f"{column} IS NOT NULL")), name
    gold = run_gold(shop.wh, "2025-01-03")
    assert len(gold) == 19 and gold["campaign_daily"].count() > 0
    refresh_gold(shop.wh, root, [])


def raw(*items):
    return json.dumps({"items": items[0] if isinstance(items[0], str) else list(items)})


def test_backfill_job_fills_both_item_forms_in_place(spark, tmp_path):
    shop = Shop(spark, str(tmp_path / "wh"))
    text = raw("[{item_id=P1, item_category=Shoes}, {item_id=P2, item_category=(not set)}]")
    listed = raw({"item_id": "P1", "item_category": "Hats", "coupon": "None"}, {"item_id": "P2", "item_category": "Caps"})
    days = [BASE, BASE + timedelta(days=1), BASE + timedelta(days=2)]
    shop.load([event("a", "view_item", 0, "u", product="P1", raw_event=text, ingestion_timestamp=days[0])])
    shop.load([event("b", "view_item", 0, "u", product="P2", raw_event=text, ingestion_timestamp=days[1])])
    shop.load([event("c", "view_item", 0, "u", product="P2", raw_event=listed, ingestion_timestamp=days[2]),
               event("d", "view_item", 0, "u", product="P1", raw_event=listed, ingestion_timestamp=days[2])])
    fields = ("product_category_1", "coupon")
    before = files_of(shop.wh.path("stg_events"))
    stats = {r.field: (r.null_rows, r.values_found) for r in run_backfill(shop.wh, fields, dry_run=True).collect()}
    assert stats == {"product_category_1": (4, 3), "coupon": (4, 0)} and files_of(shop.wh.path("stg_events")) == before
    done = run_backfill(shop.wh, fields)
    assert done == {"dates": [days[0].date(), days[2].date()], "rows_filled": 3}
    found = {r.event_id: (r.product_category_1, r.coupon) for r in staged(shop.wh, fields).collect()}
    assert found == {"a": ("Shoes", None), "b": (None, None), "c": ("Caps", None), "d": ("Hats", None)}
    assert any("ingestion_date=2025-01-02" in f for f in before & files_of(shop.wh.path("stg_events")))
    # Nothing is left to fill, and other readers see the same rows as before.
    assert run_backfill(shop.wh, fields) == {"dates": [], "rows_filled": 0}
    assert Counter(r.event_id for r in shop.wh.table("stg_events").collect()) == Counter("abcd")
    assert run_silver(shop.wh)["net_new_rows"] == 4
    first = backfill(staged(shop.wh, fields).drop(*fields), fields, item_index=0)
    assert {r.event_id: r.product_category_1 for r in first.collect()} == {"a": "Shoes", "b": "Shoes", "c": "Hats", "d": "Hats"}


def test_cart_value_column_is_an_option(spark, tmp_path):
    from decimal import Decimal

    shop = Shop(spark, str(tmp_path / "wh"))
    shop.load([event("a", "begin_checkout", 0, "u", price=100, price_in_usd=Decimal(7))])
    run_silver(shop.wh, Options(cart_value_column="price_in_usd"))
    assert shop.wh.table("silver_session_features").first()["cart_value"] == 7


def test_attributes_of_campaigns_come_from_a_catalog(spark, tmp_path):
    shop = Shop(spark, str(tmp_path / "wh"))
    shop.load([event("a", "view_item", 0, "u", discount_campaigns="C1|C2")])
    catalog = spark.createDataFrame([("C1", "Spring")], "campaign_id string, campaign_name string")
    run_silver(shop.wh, catalogs={"dim_campaigns": catalog})
    named = {r.campaign_id: r.campaign_name for r in shop.wh.table("dim_campaigns").collect()}
    assert named["C1"] == "Spring" and set(named) == {"C1", "C2"}
    assert silver.SESSION_TABLES == tuple(BUCKETED)
