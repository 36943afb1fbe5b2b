"""As-of lookup against brute force."""

import random
from datetime import timedelta

import pytest
from conftest import BASE, content, event, stage

from tidemark.operators import attribution, sessions
from tidemark.operators.asof import asof_join
from tidemark.operators.facts import fct_events
from tidemark.sources.lookups import dim_platforms


def sides(spark, seed=0, n=120):
    rnd = random.Random(seed)

    def rows(prefix, count):
        return [
            (f"{prefix}{i}", rnd.choice(["a", "b", None]), BASE + timedelta(seconds=rnd.randrange(0, 5 * 86400, 1800)))
            for i in range(count)
        ]

    left, right = rows("l", n), rows("r", n)
    schema = "k string, who string, t timestamp_ntz"
    return left, right, spark.createDataFrame(left, schema), spark.createDataFrame(right, schema.replace("k ", "rk "))


def brute(left, right, direction, tolerance):
    out = []
    for k, who, t in left:
        best = None
        for rk, rwho, rt in right:
            if who is None or rwho != who:
                continue
            gap = (t - rt) if direction == "backward" else (rt - t)
            if gap < timedelta(0) or (tolerance and gap > tolerance):
                continue
            rank = (-gap, rk)
            if best is None or rank > best[0]:
                best = (rank, rk, rt)
        out.append(str((k, who, t, best and best[1], best and best[2])))
    return sorted(out)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("tolerance", [None, timedelta(hours=3)])
@pytest.mark.parametrize("bucket_seconds", [86400, 3600])
def test_asof_equals_brute_force(spark, direction, tolerance, bucket_seconds):
    left, right, ldf, rdf = sides(spark)
    got = asof_join(
        ldf, rdf, "t", ["who"], direction, tolerance and "3 hours", tiebreak=("rk",), bucket_seconds=bucket_seconds
    )
    rows = [str((r.k, r.who, r.t, r.matched and r.matched.rk, r.matched and r.matched.matched_on)) for r in got.collect()]
    assert sorted(rows) == brute(left, right, direction, tolerance)


def facts_of(spark, rows):
    return fct_events(stage(spark, rows), dim_platforms(spark), BASE)


def test_impression_with_the_same_timestamp_counts(spark):
    rows = [
        event("z", "view_item_list", 0, "u", list_id="L1"),
        event("a", "view_item", 0, "u"),
        event("zz", "view_item_list", 0, "u", list_id="L2"),
    ]
    found = attribution.last_touch(facts_of(spark, rows), 30).collect()
    assert [r.item_list_id for r in found] == ["L2"]


def random_facts(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(500):
        name = rnd.choice(["view_item_list", "view_item", "purchase", "other"])
        # One user has most of the rows, many of them at the same moment.
        user = "busy" if rnd.random() < 0.7 else f"u{rnd.randrange(5)}"
        rows.append(
            event(f"e{i:04d}", name, rnd.randrange(0, 600) / 2, user, list_id=f"L{i}" if name == "view_item_list" else None)
        )
    return facts_of(spark, rows)


def test_rows_without_key_or_time_match_nothing(spark):
    schema = "k string, who string, t timestamp_ntz"
    left = spark.createDataFrame([("a", None, BASE), ("b", "u", None), ("c", None, None), ("d", "u", BASE)], schema)
    right = spark.createDataFrame([("x", None, BASE), ("y", "u", None), ("z", "u", BASE)], schema.replace("k ", "rk "))
    got = {r.k: r.matched and r.matched.rk for r in asof_join(left, right, "t", ["who"]).collect()}
    assert got == {"a": None, "b": None, "c": None, "d": "z"}


def test_one_actor_at_one_moment_is_spread_over_tasks(spark):
    """All rows of one actor, most at one time: rows meet their time on equality, not in a window."""
    n = 20_000
    left = spark.range(n).selectExpr("id", "'u' AS who", "timestamp_ntz'2025-01-01 10:00:00' AS t")
    right = spark.range(n).selectExpr("'u' AS who", "timestamp_ntz'2025-01-01 09:00:00' AS t", "id AS rid")
    got = asof_join(left, right, "t", ["who"], tiebreak=("rid",))
    assert got.filter(f"matched.rid = {n - 1}").count() == n


@pytest.mark.parametrize("minutes", [5, 20, 60])
def test_last_touch_equals_brute_force(spark, minutes):
    facts = random_facts(spark, minutes)
    labelled = [r.asDict() for r in sessions.sessionize(facts, minutes).collect()]
    expected = {}
    for r in labelled:
        if r["event_name"] in attribution.ACTIONABLE:
            before = [
                (i["event_timestamp"], i["event_id"], i["item_list_id"])
                for i in labelled
                if i["event_name"] == "view_item_list"
                and i["session_id"] == r["session_id"]
                and i["event_timestamp"] <= r["event_timestamp"]
            ]
            expected[r["event_id"]] = max(before)[2] if before else None
    found = {r.event_id: r.item_list_id for r in attribution.last_touch(facts, minutes).collect()}
    assert found == expected


def test_campaign_touch_ties_and_paths_agree(spark):
    rows = [
        event("a", "view_item", 0, "u", discount_campaigns="C9|C1|"),
        event("b", "view_item", 5, "u", discount_campaigns="A|B"),
        event("c", "view_item", 90, "u", discount_campaigns=""),
    ]
    facts = facts_of(spark, rows)
    from_rows = attribution.campaign_last_touch(sessions.sessionize(facts, 30))
    assert [(r.campaign_id, r.last_touch_ts) for r in from_rows.collect()] == [("B", BASE + timedelta(minutes=5))]
    rolled = attribution.rollup_campaign_touch(sessions.session_rollup(facts, 30))
    assert content(rolled, *from_rows.columns) == content(from_rows)


def test_a_session_of_many_cells_lists_each_product_once(spark):
    """A checkout every minute for 3,000 minutes, of three products and without one."""
    rows = [event(f"e{i}", "begin_checkout", i, "u", product=(None, "P1", "P2", "P3")[i % 4], quantity=2) for i in range(3000)]
    rows += [event(f"x{i}", "view_item", i, "v") for i in (0, 5, 100)]
    facts = facts_of(spark, rows)
    rolled = {r.user_id: r for r in sessions.session_rollup(facts, 30).collect() if r.views != 1}
    assert (rolled["u"].cart_products, rolled["u"].events_in_session, rolled["u"].cart_value) == (["P1", "P2", "P3"], 3000, 600_000)
    assert (rolled["v"].cart_products, rolled["v"].views) == (None, 2)
    labelled = sessions.user_sessions(sessions.sessionize(facts, 30))
    joined = sessions.session_features(labelled, sessions.cart_metrics(labelled, facts, 30))
    assert content(sessions.rollup_features(sessions.session_rollup(facts, 30))) == content(joined)
