"""Parsing, event ids, validation and backfill on hand-written lines."""

import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import ga4
from tidemark.operators import backfill, ingest
from tidemark.options import ITEM_PARAMS
from tidemark.sources import events as ev

TS = 1735725600000000
ITEM = (
    "{item_id=P1, item_name=Red Shoe, item_category=Shoes, item_list_id=(not set), item_list_name=null, "
    "price_in_usd=10.5, price=200, quantity=2, item_revenue=-3, coupon=None, item_params=["
    "{key=discountt, value={string_value=null, int_value=15, float_value=null, double_value=null}}, "
    "{key=totalPrice, value={string_value=$1,200.50, int_value=null}}, "
    "{key=number_of_installments, value={int_value=6}}, "
    "{key=discounts, value={string_value=A||B|XP_1|XP_2}}, {key=in_stock, value={string_value=true}}]}"
)


def event(items, **over):
    base = {"event_timestamp": TS, "user_id": "u", "event_name": "view_item", "platform": "IOS", "items": items}
    return json.dumps({**base, **over})


def flat(spark, *lines):
    parsed = ev.parse_lines(spark.createDataFrame([(line,) for line in lines], "value string"))
    good, dead = ev.split_parsed(parsed)
    return ingest.flatten_events(good, "2025-01-02 00:00:00"), dead


def test_item_fields(spark):
    row = flat(spark, event(f"[{ITEM}]"))[0].collect()[0]
    assert (row.product_id, row.product_name) == ("P1", "Red Shoe")
    assert row.item_list_id is None and row.item_list_name is None
    assert (row.price_in_usd, row.price, row.quantity) == (Decimal("10.5"), Decimal("200"), 2)
    assert row.item_revenue is None  # a sign is not part of the number format
    assert (row.discount_value, row.total_price, row.installments) == (15, Decimal("1200.50"), 6)
    assert row.is_in_stock is True
    assert (row.discount_campaigns, row.discount_experiment_variant) == ("A||B", "XP_2")
    assert str(row.event_timestamp) == "2025-01-01 10:00:00"


def test_items_forms(spark):
    listed = [{"item_id": "P7", "price": 3.5, "quantity": 1, "item_list_id": None}]
    df, _ = flat(
        spark, event(f"[{ITEM}, {ITEM.replace('P1', 'P2')}]"), event("[]"), event(None), event(""), event(listed),
        event("[{item_id=last}]"),
    )
    assert sorted(r.product_id for r in df.collect()) == ["P1", "P2", "P7", "last"]


def test_long_item_text_is_split_whole(spark):
    big = "{item_id=A, item_name=" + "x" * 200_000 + ", price=1}"
    df = spark.createDataFrame([(f"[{big},{ITEM}]",)], "t string")
    items = df.select(ga4.split_items("t").alias("i")).collect()[0].i
    assert items == [big, ITEM]


def split(spark, text):
    return spark.range(1).select(ga4.split_items(F.lit(text)).alias("i")).first().i


def test_items_of_any_depth(spark):
    deep = "{item_id=P1, item_params=[{key=a, value={string_value={x={y={z=1}}}}}]}"
    assert split(spark, f"[{deep}, {ITEM}, {deep}]") == [deep, ITEM, deep]
    nest = "{" * 40 + "x" + "}" * 40
    assert split(spark, f"[{nest}]") == [nest]
    assert split(spark, "[}{a=1}]") == ["{a=1}"]
    assert split(spark, "[]") == split(spark, "") == []


def test_event_id_of_many_backslashes(spark):
    for n in (1, 2, 64, 65, 200, 201):
        user = "\\" * n + "é" + "\\" * n + "u00E9"
        df = spark.createDataFrame([(TS, user)], "m long, u string").selectExpr("*", "'e' AS n", "'p' AS p")
        body = json.dumps({"evt": "e", "pid": "p", "ts": str(TS * 1000), "uid": user}, sort_keys=True)
        assert df.select(ga4.event_id("m", "u", "n", "p")).first()[0] == hashlib.sha256(body.encode()).hexdigest()


def test_odd_timestamps_are_read_or_become_dead_letters(spark):
    stamps = [TS, f"{TS}.0", str(TS), TS * 1000, "9.3e18", 10**20, "", "soon", -1]
    rows, _ = flat(spark, *[event(f"[{ITEM}]", event_timestamp=s, user_id=str(k)) for k, s in enumerate(stamps)])
    good, bad = ingest.validate(rows)
    assert sorted(r.user_id for r in good.collect()) == ["0", "1", "2", "8"]
    assert {r.stage for r in bad.collect()} == {"validate"} and bad.count() == 5
    assert len({r.event_timestamp for r in good.filter("user_id < 3").collect()}) == 1


@pytest.mark.parametrize(
    "user, product",
    [("u1", "P1"), (None, None), ('q"uo\\te', "é漢"), ("tab\t\x01", "\\u00E9 É"), ("😀", "\x7f/")],
)
def test_event_id_recipe(spark, user, product):
    text = json.dumps(
        {"ts": str(TS * 1000), "uid": str(user), "evt": "view_item", "pid": str(product or "")}, sort_keys=True
    )
    df = spark.createDataFrame([(TS, user, "view_item", product)], "m long, u string, n string, p string")
    got = df.select(ga4.event_id("m", "u", "n", "p").alias("id")).collect()[0].id
    assert got == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "codes, expected",
    [
        (None, (None, None)), ("", (None, None)), ("A|B", ("A|B", None)), ("XP_1", (None, "XP_1")),
        ("XP_1|A|XP_2", ("A", "XP_2")), ("A||B", ("A||B", None)),
    ],
)
def test_split_discounts(spark, codes, expected):
    df = spark.createDataFrame([(codes,)], "c string")
    assert tuple(df.select(ga4.split_discounts("c", "XP_").alias("d")).collect()[0].d) == expected


def test_dead_letters(spark, tmp_path):
    df, dead = flat(
        spark, '{"broken', "[1,2]", "", "{'event_name': 'x'}",
        event(f"[{ITEM}]", event_timestamp=None), event(f"[{ITEM}]", event_name=None),
        event(f"[{ITEM.replace('price=200', 'price=99999999999999')}]", user_id="big"), event(f"[{ITEM}]"),
    )
    good, bad = ingest.validate(df)
    assert [r.error for r in dead.collect()] == ["invalid_json"] * 4
    errors = {(r.stage, r.error) for r in bad.collect()}
    assert errors == {
        (
            "validate",
            "missing_required:event_id,missing_required:event_timestamp,invalid:event_timestamp,invalid:event_id",
        ),
        ("validate", "missing_required:event_name"),
        ("insert", "uncastable:price"),
    }
    assert good.count() == 1
    path = str(tmp_path / "dead")
    ev.write_dead_letters(dead.unionByName(bad), path)
    records = spark.read.json(path)
    assert records.count() == 7
    assert json.loads(records.filter("stage = 'insert'").first().flat_record)["user_id"] == "big"


def test_metrics_and_counts(spark):
    lines = [event(f"[{ITEM}]"), event("[]"), "nope", event(f"[{ITEM}]", event_name=None)]
    parsed = ev.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert tuple(ingest.parse_metrics(parsed).first()) == (4, 3, 1)
    seen, observation = ingest.observe_parse(parsed)
    seen.collect()
    assert observation.get == {"lines": 4, "parsed_ok": 3, "parse_dead": 1}
    good, _ = ev.split_parsed(parsed)
    assert ingest.without_items(good).first()[0] == 1
    assert {r.event_name: r.events for r in ev.event_counts(good).collect()} == {"view_item": 2, "unknown_event": 1}


def test_numeric_parameter_text(spark):
    df = spark.createDataFrame([("$5",), ("-2.5",), ("abc",), ("1.2.3",)], "t string")
    found = [r.n for r in df.select(ga4.plain_number("t").alias("n")).collect()]
    assert found == ["5", "-2.5", None, "1.2.3"]  # the last one fails its cast and is dead-lettered


def test_backfill(spark):
    two = f"[{ITEM}, {ITEM.replace('P1', 'P2').replace('Shoes', 'Hats')}]"
    df = spark.createDataFrame(
        [("1", "P2", json.dumps({"items": two}), None), ("2", "P1", json.dumps({"items": two}), "old"),
         ("3", "P3", json.dumps({"items": two}), None)],
        "event_id string, product_id string, raw_event string, product_category_1 string",
    )
    fields = ("product_category_1", "coupon")
    got = {r.event_id: (r.product_category_1, r.coupon) for r in backfill.backfill(df, fields).collect()}
    assert got == {"1": ("Hats", None), "2": ("old", None), "3": (None, None)}
    first = backfill.backfill(df, fields, item_index=0).collect()
    assert [r.product_category_1 for r in first] == ["Shoes", "old", "Shoes"]
    stats = {r.field: (r.null_rows, r.values_found) for r in backfill.backfill(df, fields, dry_run=True).collect()}
    assert stats == {"product_category_1": (2, 1), "coupon": (3, 0)}
    with pytest.raises(ValueError):
        backfill.backfill(df, ("nope",))


def test_round_trip_of_known_parameters(spark):
    df = spark.createDataFrame([(ITEM,)], "t string")
    item = ga4.parse_items(df, "t", ITEM_PARAMS).select("item.*").first().asDict()
    assert set(ITEM_PARAMS.values()) <= set(item)
    assert item["installment_price"] is None and item["total_price"] == "1200.50"
    assert df.select(F.size(ga4.split_items(F.lit(None).cast("string")))).first()[0] == 0
