"""End-to-end scenarios: rows in staging, one silver run per batch, assertions on the silver tables."""

from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import BASE, Shop, event

from tidemark.plans.gold import run_gold
from tidemark.plans.silver import run_silver

COUNTS = ("events_in_session", "views", "checkouts", "purchases")

# Each scenario has its own user; the first list is its first batch, the second its second.
SCENARIOS = {
    "last_touch": (
        [
            event("i1", "view_item_list", 0, "u1", "IOS", "L1"),
            event("v1", "view_item", 10, "u1", "IOS"),
            event("c1", "begin_checkout", 20, "u1", "IOS"),
            event("p1", "purchase", 25, "u1", "IOS", revenue=1),
            event("i2", "view_item_list", 40, "u1", "IOS", "L2"),
            event("v2", "view_item", 50, "u1", "IOS"),
            event("p2", "purchase", 55, "u1", "IOS", revenue=1),
            event("p3", "purchase", 120, "u1", "IOS", revenue=1),
        ],
        [],
    ),
    "no_duplicates": (
        [event("a1", "view_item_list", 0, "a", list_id="l1"), event("a2", "view_item", 5, "a")],
        [event("a3", "begin_checkout", 20, "a"), event("a4", "purchase", 25, "a", revenue=100)],
    ),
    "end_extends": (
        [event("b1", "view_item_list", 0, "b", list_id="l1"), event("b2", "view_item", 2, "b")],
        [event("b3", "view_item", 15, "b")],
    ),
    "gap": (
        [event("c1x", "view_item_list", 0, "c", list_id="l1"), event("c2x", "view_item", 5, "c")],
        [event("c3x", "view_item", 40, "c"), event("c4x", "purchase", 42, "c", revenue=5)],
    ),
    "two_users": (
        [event("d1", "view_item", 0, "d"), event("e1", "view_item", 1, "e")],
        [event("d2", "purchase", 10, "d", revenue=1), event("e2", "purchase", 11, "e", revenue=1)],
    ),
    "replay": (
        [
            event("f1", "view_item_list", 0, "f", list_id="l1"),
            event("f2", "view_item", 0, "f"),
            event("f3", "begin_checkout", 0, "f"),
        ],
        [
            event("f1", "view_item_list", 0, "f", list_id="l1"),
            event("f2", "view_item", 0, "f"),
            event("f3", "begin_checkout", 0, "f"),
        ],
    ),
    "platforms": (
        [
            event("g1", "view_item", 0, "g", "IOS"), event("g2", "purchase", 5, "g", "IOS", revenue=1),
            event("g3", "view_item", 2, "g"), event("g4", "purchase", 7, "g", revenue=1),
        ],
        [],
    ),
    "unknown_actor": (
        [
            event("h1", "view_item", 0, "h"), event("h2", "view_item", 1, "h", platform="WEB"),
            event("h3", "view_item", 2, None),
        ],
        [],
    ),
    # Ingested later but older in event time: still picked up, and it comes before the stored event.
    "older_event_later": ([event("k1", "view_item", 100, "k")], [event("k2", "view_item", 80, "k")]),
}


class Stored:
    def __init__(self, shop):
        self.by_user = {}
        for r in shop.rows("silver_user_sessions", "user_id", "session_start_ts", "session_end_ts", *COUNTS,
                           order=("user_id", "session_start_ts")):
            self.by_user.setdefault(r[0], []).append(r[1:])
        self.lists = dict(shop.rows("silver_event_list_attribution", "event_id", "item_list_id"))
        self.facts = [r[0] for r in shop.rows("fct_events", "event_id")]

    def counts(self, user):
        return [r[2:] for r in self.by_user[user]]


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """Silver after the first and after the second batch of all scenarios."""
    shop = Shop(spark, str(tmp_path_factory.mktemp("scenarios") / "wh"))
    out = []
    for n in (0, 1):
        rows = [r for batches in SCENARIOS.values() for r in batches[n]]
        shop.load([{**r, "ingestion_timestamp": BASE + timedelta(days=1 + n)} for r in rows])
        run_silver(shop.wh)
        out.append(Stored(shop))
    return out


def test_last_touch_within_session(runs):
    found = {e: runs[1].lists.get(e) for e in ("v1", "c1", "p1", "v2", "p2", "p3")}
    assert found == {"v1": "L1", "c1": "L1", "p1": "L1", "v2": "L2", "p2": "L2", "p3": None}


def test_no_duplicates_across_batches(runs):
    assert runs[0].counts("a") == [(2, 1, 0, 0)]
    assert runs[1].by_user["a"] == [(BASE, BASE + timedelta(minutes=25), 4, 1, 1, 1)]
    assert len([e for e in runs[1].facts if e.startswith("a")]) == 4
    # The list seen in the first batch is the last touch of the second batch's events.
    assert (runs[1].lists["a3"], runs[1].lists["a4"]) == ("l1", "l1")


def test_session_end_extends(runs):
    assert runs[1].by_user["b"] == [(BASE, BASE + timedelta(minutes=15), 3, 2, 0, 0)]


def test_new_session_after_gap(runs):
    assert runs[1].counts("c") == [(2, 1, 0, 0), (2, 1, 0, 1)]


def test_users_are_not_mixed(runs):
    assert runs[1].counts("d") == runs[1].counts("e") == [(2, 1, 0, 1)]


def test_equal_timestamps_and_replay(runs):
    assert runs[0].counts("f") == runs[1].counts("f") == [(3, 1, 1, 0)]
    assert len(runs[1].facts) == len(set(runs[1].facts))


def test_platforms_are_kept_apart(runs):
    assert runs[1].counts("g") == [(2, 1, 0, 1), (2, 1, 0, 1)]


def test_unknown_platform_and_user_stay_in_facts_only(runs):
    assert {"h1", "h2", "h3"} <= set(runs[1].facts)
    assert runs[1].counts("h") == [(1, 1, 0, 0)]


def test_older_event_in_a_later_batch(runs):
    assert runs[1].by_user["k"] == [(BASE + timedelta(minutes=80), BASE + timedelta(minutes=100), 2, 2, 0, 0)]


def sessions(shop):
    return shop.rows("silver_user_sessions", "session_start_ts", *COUNTS, order=("session_start_ts",))


def test_empty_batch(shop):
    assert run_silver(shop.wh)["net_new_rows"] == 0
    assert sessions(shop) == []
    shop.load([event("e1", "view_item", 0, "a")])
    run_silver(shop.wh)
    mark = shop.rows("etl_checkpoints", "hwm_ts", "hwm_event_id")
    run_silver(shop.wh)
    assert shop.rows("etl_checkpoints", "hwm_ts", "hwm_event_id") == mark == [(BASE, "e1")]


def test_late_event_merges_sessions_over_midnight(shop):
    """The bridge moves a session to the day before; nothing may stay behind on its old day."""
    shop.load([event("e1", "view_item", 830, "u"), event("e3", "view_item", 870, "u")])  # 23:50 and 00:30
    run_silver(shop.wh)
    assert len(sessions(shop)) == 2
    shop.load([event("e2", "view_item", 850, "u", ingestion_timestamp=BASE + timedelta(days=2))])
    run_silver(shop.wh)
    assert sessions(shop) == [(BASE + timedelta(minutes=830), 3, 3, 0, 0)]
    assert len(shop.rows("silver_session_features", "user_id")) == 1


def test_gold_reads_committed_silver(shop):
    shop.load(
        [
            event("i1", "view_item_list", 0, "u", list_id="L1", discount_campaigns="C1|C2"),
            event("v1", "view_item", 1, "u", discount_campaigns="C1", discount_value=Decimal(10)),
            event("c1", "begin_checkout", 2, "u", product="P2", price=600),
            event("p1", "purchase", 200, "u", product="P9", revenue=7),
        ]
    )
    run_silver(shop.wh)
    gold = run_gold(shop.wh, "2025-01-01")
    day = gold["engagement_daily"].collect()
    assert [(r.campaign_id, r.sessions, r.sessions_with_click, r.ctr_sessions) for r in day] == [("C1", 1, 1, 1.0)]
    assert gold["segment_abandon_then_bought_different"].count() == 1
    assert gold["segment_high_value_abandon"].count() == 1
    assert gold["segment_bounce"].count() == 1
    status = {r.campaign_id: r for r in gold["current_status"].collect()}
    assert status["C1"].has_discount_today == 1 and status["C1"].current_discount_percentage == 10.0
    assert gold["finance_daily"].collect()[0].avg_order_value == 7.0
