"""Any split into batches gives what one run over everything gives."""

import random
from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import BASE, Shop, content, event

from tidemark.operators import sessions
from tidemark.plans.silver import run_silver
from tidemark.sources.warehouse import Warehouse

TABLES = {
    "silver_user_sessions": (),
    "silver_session_features": (),
    "silver_list_impressions": (),
    "silver_event_list_attribution": (),
    "silver_session_campaign_last_touch": (
        "user_id", "platform_id", "session_id", "session_start_ts", "campaign_id", "last_touch_ts",
    ),
    "fct_product_daily_performance": (),
    "dim_products": (),
    "fct_product_campaigns": (),
    "dim_campaigns": ("campaign_id", "campaign_name", "effective_start_date", "is_active"),
    "dim_experiments": ("experiment_id", "effective_start_date", "is_active"),
    "dim_item_lists": ("item_list_id", "effective_start_date", "is_active"),
    "fct_events": ("event_id", "event_timestamp", "user_id", "platform_id", "date_id", "price"),
}


def random_rows(seed, n=160):
    rnd = random.Random(seed)
    names = ["view_item_list", "view_item", "begin_checkout", "purchase", "other"]
    rows = []
    for i in range(n):
        name = rnd.choice(names)
        rows.append(
            event(
                f"e{i:04d}", name, rnd.randrange(0, 3600), f"u{rnd.randrange(4)}",
                rnd.choice(["IOS", "android", "WEB"]),
                list_id=f"L{rnd.randrange(3)}" if name == "view_item_list" else None,
                product=f"P{rnd.randrange(4)}", price=rnd.randrange(1, 5) * 100,
                revenue=rnd.randrange(50) if name == "purchase" else None,
                discount_campaigns=rnd.choice([None, "C1", "C1|C2", "C2|C3"]),
                discount_experiment_variant=rnd.choice([None, "XP_1"]),
                discount_value=Decimal(rnd.randrange(3)), installments=rnd.randrange(3),
            )
        )
    return rows


def run_in(shop, batches):
    for n, rows in enumerate(batches):
        for r in rows:
            r["ingestion_timestamp"] = BASE + timedelta(days=10 + n)
        shop.load(rows)
        run_silver(shop.wh)


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_one_run(spark, tmp_path, seed):
    rows = random_rows(seed)
    whole, split = Shop(spark, str(tmp_path / "a")), Shop(spark, str(tmp_path / "b"))
    run_in(whole, [[dict(r) for r in rows]])
    shuffled = [dict(r) for r in rows]
    random.Random(seed).shuffle(shuffled)
    run_in(split, [shuffled[0::3], shuffled[1::3], shuffled[2::3]])
    for table, cols in TABLES.items():
        assert content(split.wh.table(table), *cols) == content(whole.wh.table(table), *cols), table

    # Dimension timelines: no overlap, one open version per key.
    for dim, key in (("dim_users", "user_id"), ("dim_products", "product_id")):
        by_key = {}
        for r in split.wh.table(dim).collect():
            by_key.setdefault(r[key], []).append((r.effective_start_date, r.effective_end_date, r.is_active))
        for versions in by_key.values():
            versions.sort()
            assert [v[2] for v in versions] == [False] * (len(versions) - 1) + [True]
            assert all(a[1] == b[0] for a, b in zip(versions, versions[1:]))


def test_crashed_run_is_repeated_without_double_counting(spark, tmp_path, monkeypatch):
    rows = random_rows(3)
    clean, crashed = Shop(spark, str(tmp_path / "a")), Shop(spark, str(tmp_path / "b"))
    run_in(clean, [[dict(r) for r in rows[:80]], [dict(r) for r in rows[80:]]])
    run_in(crashed, [[dict(r) for r in rows[:80]]])

    write = Warehouse.write_snapshot

    def failing(self, name, df, seq):
        if name == "etl_checkpoints":
            raise RuntimeError("lost")
        write(self, name, df, seq)

    monkeypatch.setattr(Warehouse, "write_snapshot", failing)
    with pytest.raises(RuntimeError):
        run_in(crashed, [[dict(r) for r in rows[80:]]])
    monkeypatch.setattr(Warehouse, "write_snapshot", write)
    run_silver(crashed.wh)
    for table, cols in {**TABLES, "fct_product_campaigns": ()}.items():
        assert content(crashed.wh.table(table), *cols) == content(clean.wh.table(table), *cols), table


def test_compacted_deltas_read_the_same(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    schema = wh.table("fct_product_daily_performance", 0).schema
    for seq in (1, 2, 3):
        wh.write_delta("fct_product_daily_performance", spark.createDataFrame(
            [(20250101, "P", seq, 0, 1, Decimal(seq)), (20250100 + seq, "Q", 1, 1, 0, Decimal(0))], schema), seq)
    before = content(wh.table("fct_product_daily_performance", 3))
    wh.tidy(2, compact_every=2)
    assert wh._runs("fct_product_daily_performance", "base_seq") == [2]
    assert content(wh.table("fct_product_daily_performance", 3)) == before
    # A reader of an earlier state does not see the later runs.
    assert max(r.views for r in wh.table("fct_product_daily_performance", 1).collect()) == 1


def brute_sessions(rows, minutes):
    by_actor = {}
    for r in rows:
        if r["user_id"] and r["platform"].upper() != "WEB":
            by_actor.setdefault((r["user_id"], r["platform"].upper()), []).append(r["event_timestamp"])
    out = []
    for actor, times in by_actor.items():
        times.sort()
        start, prev, n = times[0], times[0], 0
        for t in times:
            if t - prev > timedelta(minutes=minutes):
                out.append((actor[0], start, prev, n))
                start, n = t, 0
            prev, n = t, n + 1
        out.append((actor[0], start, prev, n))
    return sorted(out, key=str)


@pytest.mark.parametrize("minutes", [1, 7, 30, 240])
def test_sessions_equal_brute_force(spark, minutes):
    from conftest import stage

    from tidemark.operators.facts import fct_events
    from tidemark.sources.lookups import dim_platforms

    rows = random_rows(5, 400)
    facts = fct_events(stage(spark, rows), dim_platforms(spark), BASE)
    found = sessions.user_sessions(sessions.sessionize(facts, minutes))
    got = [(r.user_id, r.session_start_ts, r.session_end_ts, r.events_in_session) for r in found.collect()]
    assert sorted(got, key=str) == brute_sessions(rows, minutes)
    rolled = sessions.rollup_sessions(sessions.session_rollup(facts, minutes))
    assert content(rolled, *found.columns) == content(found)


def test_pause_of_exactly_the_gap_stays_in_session(spark):
    from conftest import stage

    from tidemark.operators.facts import fct_events
    from tidemark.sources.lookups import dim_platforms

    rows = [event("a", "view_item", 0, "u"), event("b", "view_item", 30, "u"), event("c", "view_item", 60.02, "u")]
    facts = fct_events(stage(spark, rows), dim_platforms(spark), BASE)
    assert sessions.sessionize(facts, 30).select("session_id").distinct().count() == 2
