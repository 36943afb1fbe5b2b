"""Dimension timelines with several and late changes."""

from datetime import date, timedelta

from conftest import BASE, content, event, stage

from tidemark import schemas
from tidemark.operators import facts, gold, scd, upsert

DAY = 1440


def d(n):
    return (BASE + timedelta(days=n)).date()


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_reverts_and_several_changes_in_one_batch(spark):
    rows = [event(f"e{i}", "view_item", i * DAY, "u", price=p) for i, p in enumerate([10, 10, 20, 10, 10])]
    rows.append(event("late_same_day", "view_item", 2 * DAY + 5, "u", price=30))
    dim = scd.dim_products(scd.product_day(stage(spark, rows)))
    found = [
        (int(r.price), r.effective_start_date, r.effective_end_date, r.is_active)
        for r in dim.orderBy("effective_start_date").collect()
    ]
    assert found == [(10, d(0), d(2), False), (30, d(2), d(3), False), (10, d(3), None, True)]
    assert dim.select("product_sk").distinct().count() == 3


def test_late_change_splits_an_interval(spark):
    dim = spark.createDataFrame(
        [("a", 1, "x", d(0), d(10), False), ("a", 2, "y", d(10), None, True)],
        "k string, v int, note string, effective_start_date date, effective_end_date date, is_active boolean",
    )
    changes = spark.createDataFrame(
        [("a", d(5), 7), ("a", d(10), 3), ("b", d(1), 9)], "k string, change_date date, v int"
    )
    merged = scd.scd2_merge(dim, changes, "k", ["v"]).orderBy("k", "effective_start_date")
    assert [tuple(r) for r in merged.collect()] == [
        ("a", 1, "x", d(0), d(5), False),
        ("a", 7, "x", d(5), d(10), False),
        ("a", 3, "y", d(10), None, True),
        ("b", 9, None, d(1), None, True),
    ]


def test_users_over_batches(spark):
    first = stage(spark, [event("1", "view_item", 0, "u")])
    none = empty(spark, schemas.DIM_USERS)
    dim = scd.merge_users(none, scd.user_changes(first, none))
    later = stage(
        spark,
        [event("2", "purchase", 2 * DAY, "u"), event("3", "purchase", 5 * DAY, "u", installments=3)],
    )
    dim = scd.merge_users(dim, scd.user_changes(later, dim))
    early = stage(spark, [event("4", "purchase", 1 * DAY, "u")])
    dim = scd.merge_users(dim, scd.user_changes(early, dim))
    found = [
        (r.effective_start_date, r.effective_end_date, r.first_purchase_date, r.has_used_installments)
        for r in dim.orderBy("effective_start_date").collect()
    ]
    assert found == [
        # A late change starts from the active version, so it carries that version's flag.
        (d(0), d(1), None, False), (d(1), d(2), d(1), True), (d(2), None, d(1), True),
    ]
    assert scd.user_changes(early, dim).count() == 0


def test_insert_if_unseen_and_name_refresh(spark):
    none = empty(spark, schemas.DIM_ITEM_LISTS)
    one = stage(spark, [event("1", "view_item_list", DAY, "u", list_id="L1", item_list_name=None)])
    two = stage(
        spark,
        [event("2", "view_item_list", 0, "u", list_id="L1"), event("3", "view_item_list", 0, "u", list_id="L2")],
    )
    dim = scd.merge_item_lists(scd.merge_item_lists(none, one), two)
    found = {r.item_list_id: (r.item_list_name, r.effective_start_date) for r in dim.collect()}
    assert found == {"L1": ("List L1", d(0)), "L2": ("List L2", d(0))}


def test_campaign_catalog_and_empty_codes(spark):
    rows = stage(spark, [event("1", "view_item", 0, "u", discount_campaigns="A||B"), event("2", "view_item", 0, "u", discount_campaigns="")])
    catalog = spark.createDataFrame([("A", "Autumn", "mail")], "campaign_id string, campaign_name string, targeting_source string")
    dim = scd.merge_campaigns(empty(spark, schemas.DIM_CAMPAIGNS), rows, catalog)
    found = {r.campaign_id: (r.campaign_name, r.targeting_source) for r in dim.collect()}
    assert found == {"A": ("Autumn", "mail"), "B": (None, None)}


def test_point_in_time_join_keeps_every_fact_once(spark):
    dim = scd.timeline(
        spark.createDataFrame([("a", d(0), 1), ("a", d(3), 2)], "k string, day date, v int"), "k", "day", ["v"]
    )
    rows = spark.createDataFrame(
        [("a", d(i % 5), i) for i in range(20)] + [("a", date(2020, 1, 1), 99), ("z", d(1), 98)],
        "k string, day date, n int",
    )
    joined = scd.as_of_join(rows, dim, "k", "day")
    assert {(r.n, r.v) for r in joined.collect()} == {(i, 1 if i % 5 < 3 else 2) for i in range(20)}
    assert joined.count() == 20
    assert scd.as_of_join(rows, dim, "k", "day", "left").count() == 22


def test_code_listed_twice(spark):
    rows = stage(spark, [event("1", "purchase", 0, "u", revenue=4, discount_campaigns="A|A")])
    dims = scd.merge_campaigns(empty(spark, schemas.DIM_CAMPAIGNS), rows), scd.dim_products(scd.product_day(rows))
    assert facts.product_campaigns(rows, *dims).first().purchases == 2
    assert facts.product_campaigns(rows, *dims, distinct_codes=True).first().purchases == 1


def test_bought_something_else_after_abandoning(spark):
    schema = schemas.SESSION_FEATURES

    def feature(user, end, cart):
        row = dict.fromkeys(schema.names)
        row.update(user_id=user, platform_id=1, session_start_ts=BASE, session_end_ts=end,
                   is_abandoned_checkout=True, cart_products=cart)
        return tuple(row[c] for c in schema.names)

    later = BASE + timedelta(hours=1)
    features = spark.createDataFrame(
        [feature("same", BASE, ["P1"]), feature("other", BASE, ["P1"]), feature("before", later, ["P1"]),
         feature("both", BASE, ["P1", "P2"]), feature("unknown", BASE, ["P1"]), feature("nocart", BASE, None)],
        schema,
    )
    bought = spark.createDataFrame(
        [("same", 1, "P1", later), ("same", 1, "P1", later + timedelta(hours=1)), ("other", 1, "P1", later),
         ("other", 1, "P3", later), ("before", 1, "P3", later), ("both", 1, "P2", later), ("both", 1, "P1", later),
         ("unknown", 1, None, later), ("nocart", 1, "P1", later)],
        "user_id string, platform_id int, product_id string, event_timestamp timestamp_ntz",
    )
    found = gold.abandon_then_bought_different(features, bought)
    assert sorted(r.user_id for r in found.collect()) == ["nocart", "other", "unknown"]


def test_price_change_view_repeats_per_observed_row_unless_distinct(spark):
    products = spark.createDataFrame(
        [("P", 10, d(0)), ("P", 20, d(2))], "product_id string, price int, effective_start_date date"
    )
    campaigns = spark.createDataFrame(
        [("C", "C", d(0), None)],
        "campaign_id string, campaign_name string, effective_start_date date, effective_end_date date",
    )
    fpc = spark.createDataFrame(
        [("P", "C", d(0), d(5)), ("P", "C", d(1), d(4))],
        "product_id string, campaign_id string, first_seen_date date, last_seen_date date",
    )
    assert [r.delta_pct for r in gold.price_change_events(products, campaigns, fpc).collect()] == [1.0, 1.0]
    assert gold.price_change_events(products, campaigns, fpc, distinct=True).count() == 1


def test_upserts(spark):
    target = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "k string, n int, m int")
    updates = spark.createDataFrame([("b", 10, 1), ("c", 20, 9)], "k string, n int, m int")
    assert content(upsert.upsert_replace(target, updates, ["k"])) == sorted(["('a', 1, 5)", "('b', 10, 1)", "('c', 20, 9)"])
    added = upsert.upsert_additive(target, updates, ["k"], sums=["n"], maxs=["m"])
    assert content(added) == sorted(["('a', 1, 5)", "('b', 12, 6)", "('c', 20, 9)"])
    assert content(upsert.append_new(target, updates, ["k"])) == ["('c', 20, 9)"]


def test_many_versions_and_days_of_one_key_are_swept(spark):
    """3,000 versions x 3,000 days of each key: settled by one line per key, without a range join."""
    keys = spark.range(40).selectExpr("cast(id as string) AS k")
    each = keys.selectExpr("k", "explode(sequence(0, 2999)) AS n")
    starts = each.selectExpr("k", "n AS v", "date_add(date'2000-01-01', n * 2) AS effective_start_date")
    dim = scd.close_intervals(starts, "k")
    days = each.selectExpr("k", "n", "date_add(date'2000-01-01', n * 2 + n % 2 - 1) AS day")
    joined = scd.as_of_join(days, dim, "k", "day", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "<=" not in plan
    # Even days fall a day before their own version's start, odd ones on it; the first lies before all versions.
    assert joined.filter("v IS NULL").count() == 40
    assert joined.filter("v IS NOT NULL AND v <> n - 1 + n % 2").count() == 0


def test_versions_on_odd_rows(spark):
    dim = spark.createDataFrame(
        [("a", 1, d(0), d(2)), ("a", 2, d(4), None), (None, 3, d(0), None), ("b", 4, None, None)],
        "k string, v int, effective_start_date date, effective_end_date date",
    )
    days = spark.createDataFrame(
        [("a", d(-1)), ("a", d(0)), ("a", d(0)), ("a", d(2)), ("a", d(4)), ("a", None), (None, d(1)), ("b", d(1)), ("c", d(1))],
        "k string, day date",
    )
    assert content(scd.as_of_join(days, dim, "k", "day"), "k", "day", "v") == sorted(
        str(r) for r in [("a", d(0), 1), ("a", d(0), 1), ("a", d(4), 2)]
    )
    assert scd.as_of_join(days, dim, "k", "day", "left").count() == 9
    assert scd.versions_on(days.limit(0), dim, "k", "day").count() == 0


def test_line_versions_are_dealt_by_the_number_of_lines(spark, monkeypatch):
    """A task's rows, and so its memory, do not grow with the table: partitions do."""
    from catalog import silver_queries
    from catalog.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    plain = content(QUERIES["S4_scd2_merge"](spark, sf))
    monkeypatch.setattr(silver_queries, "TASK_ROWS", 400)
    n = -(-silver_queries.read(spark, sf, "lineitem").count() // 400)
    merged = QUERIES["S4_scd2_merge"](spark, sf)
    assert n > 8 and merged.rdd.getNumPartitions() == n
    assert QUERIES["S6_open_versions"](spark, sf).rdd.getNumPartitions() == n
    assert content(merged) == plain
