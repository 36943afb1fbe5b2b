"""Raw lines, parsing, validation, backfill, streams and the whole job.

The raw lines are derived from the events table: each event becomes a JSON line with an item text, some of
them with two items, as a JSON list, without a timestamp, or cut off.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from catalog import fragments as frag
from catalog.adapter import MINUTES, RUN_TS, read, staged, stg
from catalog.registry import FRAGMENTS, fragment, query
from tidemark.functions import ga4
from tidemark.functions.columns import pin
from tidemark.operators import backfill, ingest
from tidemark.options import Options
from tidemark.plans.gold import run_gold
from tidemark.plans.silver import run_silver
from tidemark.session import scratch_dir
from tidemark.sources import events as ev
from tidemark.sources import lookups
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming import jobs
from tidemark.streaming import sessions as streamed

OPTIONS = Options(session_minutes=MINUTES, high_value_threshold=frag.THRESHOLD)


def _text(c):
    return F.coalesce(c.cast("string"), F.lit("(not set)"))


def raw_lines(spark, sf, events=None):
    """One JSON line per event, of all events or the given ones.

    The events, a small part of the lines' bytes, are dealt to all tasks: a file has few places to split at.
    """
    events = read(spark, sf, "events") if events is None else events
    k = F.get_json_object("raw_event", "$.k").cast("int")
    s = staged(events.repartition("event_id", "ts")).withColumn("k", k)
    c = F.col
    codes = F.concat_ws("|", "discount_campaigns", "discount_experiment_variant")

    def item(product, name, price):
        return F.concat(
            F.lit("{item_id="), product, F.lit(", item_name="), name,
            F.lit(", item_category=Cat "), (c("k") % 6).cast("string"),
            F.lit(", item_category2=(not set), coupon=null, item_list_id="), _text(c("item_list_id")),
            F.lit(", item_list_name="), _text(c("item_list_name")),
            F.lit(", price_in_usd="), price, F.lit(", price="), price,
            F.lit(", quantity="), c("quantity").cast("string"),
            F.lit(", item_revenue_in_usd="), F.coalesce(c("item_revenue").cast("string"), F.lit("null")),
            F.lit(", item_revenue="), F.coalesce(c("item_revenue").cast("string"), F.lit("null")),
            F.lit(", item_params=[{key=discountt, value={string_value=null, int_value="),
            c("discount_value").cast("int").cast("string"),
            F.lit(", double_value=null}}, {key=totalPrice, value={double_value="), c("total_price").cast("string"),
            F.lit("}}, {key=number_of_installments, value={int_value="), c("installments").cast("string"),
            F.lit("}}, {key=installment_price, value={string_value="),
            F.coalesce(F.concat(F.lit("$"), c("installment_price").cast("string")), F.lit("(not set)")),
            F.lit("}}, {key=discounts, value={string_value="), codes,
            F.lit("}}, {key=in_stock, value={string_value="), c("is_in_stock").cast("string"), F.lit("}}]}"),
        )

    first = item(c("product_id"), c("product_name"), c("price").cast("string"))
    second = item(
        F.concat(F.lit("Q"), (c("k") % 20).cast("string")), F.lit("Extra"), (c("price") + 1).cast("string")
    )
    listed = F.to_json(
        F.array(
            F.struct(
                c("product_id").alias("item_id"), c("product_name").alias("item_name"), "item_list_id",
                "item_list_name", "price_in_usd", "price", "quantity", "item_revenue_in_usd", "item_revenue",
                "discount_value", "total_price", "installments", "installment_price",
                F.when(codes != "", codes).alias("discounts"), "is_in_stock",
                F.concat(F.lit("Cat "), (c("k") % 6).cast("string")).alias("item_category"), F.lit("None").alias("coupon"),
            )
        )
    )
    text_items = (
        F.when(c("event_name") == "other", F.lit("[]"))
        .when(c("k") % 5 == 0, F.concat(F.lit("["), first, F.lit(", "), second, F.lit("]")))
        .otherwise(F.concat(F.lit("["), first, F.lit("]")))
    )
    quoted = F.to_json(F.struct(text_items.alias("items")))
    items = F.when((c("k") % 6 == 1) & (c("event_name") != "other"), F.concat(F.lit('{"items":'), listed, F.lit("}"))).otherwise(quoted)
    head = F.to_json(
        F.struct(
            F.when(c("k") != 96, F.unix_micros(c("event_timestamp").cast("timestamp"))).alias("event_timestamp"),
            "event_name", "user_id", "platform",
            F.date_format(c("event_timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("replay_timestamp"),
        )
    )
    line = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(","), F.substring(items, F.lit(2), F.length(items)))
    return s.select(F.when(c("k") == 97, F.substring(line, F.lit(1), F.length(line) - 3)).otherwise(line).alias("value"))


_WRITTEN: dict = {}


def raw_files(spark, sf):
    """Folder of the raw lines, written once per session for the queries that read files or streams of files."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WRITTEN:
        path = scratch_dir(spark, "raw")
        raw_lines(spark, sf).write.text(path, compression="gzip")
        _WRITTEN[key] = path
    return _WRITTEN[key]


def _parsed(spark, sf):
    """All lines parsed as they are made: stored, they are thirty times the events table."""
    return ev.parse_lines(pin(raw_lines(spark, sf).withColumnRenamed("value", "line"), "value", F.col("line")).select("value"))


def _item_rows(spark, sf):
    """Parsed items of the events whose items are text."""
    good, _ = ev.split_parsed(_parsed(spark, sf))
    texts = good.filter(~F.col("items").startswith('[{"'))
    return ga4.parse_items(texts.select(F.explode(ga4.split_items("items")).alias("t")), "t", OPTIONS.item_params)


def flat(spark, sf):
    return ingest.flatten_events(ev.split_parsed(_parsed(spark, sf))[0], RUN_TS)


# Expected event x item rows: the first item is the staged row, the second an extra one.
_ID = """sha256('{"evt": "' || event_name || '", "pid": "' || product_id || '", "ts": "' || (epoch_us(event_timestamp) * 1000)
    || '", "uid": "' || coalesce(user_id, 'None') || '"}')"""
fragment("raw_rows", f"""
SELECT * EXCLUDE (event_id), CASE WHEN k <> 96 THEN {_ID} END AS event_id FROM (
  SELECT s.*, c.k FROM stg s JOIN canon c ON CAST(c.event_id AS VARCHAR) = s.event_id WHERE s.event_name <> 'other'
  UNION ALL
  SELECT s.* REPLACE ('Q' || (k % 20) AS product_id, 'Extra' AS product_name, price_in_usd + 1 AS price_in_usd,
      price + 1 AS price), c.k
  FROM stg s JOIN canon c ON CAST(c.event_id AS VARCHAR) = s.event_id
  WHERE s.event_name <> 'other' AND k % 5 = 0 AND k % 6 <> 1)
WHERE k <> 97
""")
# A variant makes the campaign text empty rather than NULL when it is the only code.
_FLAT = """event_id, event_name, event_timestamp, user_id, platform, item_list_id, item_list_name, product_id,
  product_name, CAST(price_in_usd AS DECIMAL(12,6)) AS price_in_usd, CAST(price AS DECIMAL(12,2)) AS price, quantity,
  CAST(item_revenue_in_usd AS DECIMAL(12,6)) AS item_revenue_in_usd, item_revenue, discount_value, total_price,
  discount_campaigns, discount_experiment_variant, installments, installment_price, is_in_stock"""
fragment("raw_good", f"SELECT {_FLAT} FROM raw_rows WHERE k <> 96")


def _flat_columns(df):
    return df.drop("raw_event", "ingestion_timestamp", "replay_timestamp", "cast_errors")


@query("I1_read_events", """
SELECT CASE WHEN k <> 96 THEN CAST(epoch_us(event_timestamp) AS VARCHAR) END AS event_timestamp, s.user_id,
  s.event_name, s.platform FROM stg s JOIN canon c ON CAST(c.event_id AS VARCHAR) = s.event_id WHERE k <> 97
""")
def _(spark, sf):
    good, _ = ev.read_events(spark, raw_files(spark, sf))
    return good.select("event_timestamp", "user_id", "event_name", "platform")


@query("I2_stream_events", """
SELECT coalesce(s.event_name, 'unknown_event') AS event_name, count(*) AS events
FROM stg s JOIN canon c ON CAST(c.event_id AS VARCHAR) = s.event_id WHERE k <> 97 GROUP BY 1
""")
def _(spark, sf):
    out, mark = scratch_dir(spark, "streamed"), scratch_dir(spark, "mark")
    jobs.write_available(ev.stream_events(spark, raw_files(spark, sf), max_files=4), out, mark)
    good, _ = ev.split_parsed(ev.parse_lines(spark.read.parquet(out)))
    return ev.event_counts(good)


def _event_stream(spark, sf):
    """The events table as a stream; the pattern matches a single file as well as a folder."""
    schema = read(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")


@query("I3_dedup_messages", "SELECT event_id, ts AS event_time, event_type FROM events")
def _(spark, sf):
    stream = _event_stream(spark, sf)
    messages = stream.select("event_id", F.col("ts").cast("timestamp").alias("event_time"), "event_type")
    out, mark = scratch_dir(spark, "dedup"), scratch_dir(spark, "mark")
    # Every message arrives twice.
    twice = messages.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    jobs.write_available(jobs.dedup_messages(twice, "event_id"), out, mark)
    return spark.read.parquet(out).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("I3_pipeline_messages", "SELECT event_id, event_name, product_id, price, 1 AS staged FROM raw_good")
def _(spark, sf):
    """Every message is in two files; the stream is stopped between them and goes on from its checkpoint."""
    folder, wh, mark = scratch_dir(spark, "messages"), Warehouse(spark, scratch_dir(spark, "wh")), scratch_dir(spark, "mark")
    # The line is the body; the copies of a message share the id it was first sent under.
    envelope = F.to_json(F.struct(F.expr("uuid()").alias("MessageId"), F.col("value").alias("Body")))
    sent = raw_lines(spark, sf).select(envelope.alias("value"))
    for part in (1, 2):
        sent.write.text(f"{folder}/part={part}", compression="gzip")
        sent = spark.read.text(f"{folder}/part={part}")
        stream = ev.stream_messages(spark, f"{folder}/part=*")
        jobs.run_pipeline_stream(wh, stream, mark, OPTIONS, id_col="message_id")
    staged = wh.table("stg_events").groupBy("event_id", "event_name", "product_id", "price").agg(F.count("*").cast("int").alias("staged"))
    known = wh.table("fct_events").select("event_id").distinct()
    return staged.join(known, "event_id", "left_semi")


@query("I4_event_counts", "SELECT event_name, count(*) AS events FROM stg GROUP BY 1")
def _(spark, sf):
    return ev.event_counts(stg(spark, sf))


@query("I5_append_staging", "SELECT event_id, event_name, event_timestamp, price FROM stg UNION ALL SELECT event_id, event_name, event_timestamp, price FROM stg")
def _(spark, sf):
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    rows = stg(spark, sf)
    for _ in range(2):
        ev.append_staging(rows, wh.path("stg_events"))
    return wh.table("stg_events").select("event_id", "event_name", "event_timestamp", "price")


@query("I6_dead_letters", """
SELECT 'parse' AS stage, 'invalid_json' AS error, count(*) AS letters FROM canon WHERE k = 97 HAVING count(*) > 0
UNION ALL
SELECT 'validate', 'missing_required:event_id,missing_required:event_timestamp,invalid:event_timestamp,invalid:event_id', count(*)
FROM raw_rows WHERE k = 96 HAVING count(*) > 0
""")
def _(spark, sf):
    path = scratch_dir(spark, "dead")
    good, dead = ev.split_parsed(_parsed(spark, sf))
    _, bad = ingest.validate(ingest.flatten_events(good, RUN_TS))
    ev.write_dead_letters(dead, path)
    ev.write_dead_letters(bad, path)
    letters = spark.read.schema(
        "stage string, error string, filepath string, flat_record string, raw_event string"
    ).json(path)
    return letters.groupBy("stage", "error").agg(F.count(F.lit(1)).alias("letters"))


@query("I7_table_scan", """
SELECT event_id, event_name, date_id, price FROM facts WHERE date_id BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
""")
def _(spark, sf):
    from catalog.adapter import fct

    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    wh.append_facts(fct(spark, sf), 1)
    return wh.table("fct_events", 1).filter(F.col("date_id").between("2024-01-10", "2024-01-12")).select(
        "event_id", "event_name", "date_id", "price"
    )


@query("P1_split_items", """
SELECT CAST(items AS INTEGER) AS items, count(*) AS events FROM (
  SELECT CASE WHEN s.event_name = 'other' THEN 0 WHEN k % 6 = 1 THEN 1 WHEN k % 5 = 0 THEN 2 ELSE 1 END AS items
  FROM stg s JOIN canon c ON CAST(c.event_id AS VARCHAR) = s.event_id WHERE k <> 97) GROUP BY 1
""")
def _(spark, sf):
    good, _ = ev.split_parsed(_parsed(spark, sf))
    return good.groupBy(F.size(ga4.split_items("items")).alias("items")).agg(F.count(F.lit(1)).alias("events"))


@query("P2_parse_item", """
SELECT product_id AS item_id, product_name AS item_name, item_list_id, item_list_name,
  CAST(price_in_usd AS DECIMAL(12,2)) AS price_in_usd, CAST(price AS DECIMAL(12,2)) AS price, quantity, item_revenue
FROM raw_rows WHERE k % 6 <> 1
""")
def _(spark, sf):
    return _item_rows(spark, sf).select(
        "item.item_id", "item.item_name", "item.item_list_id", "item.item_list_name",
        *[F.col(f"item.{n}").try_cast("decimal(12,2)").alias(n) for n in ("price_in_usd", "price")],
        F.col("item.quantity").cast("int").alias("quantity"),
        F.col("item.item_revenue").try_cast("decimal(12,2)").alias("item_revenue"),
    )


@query("P3_parse_params", """
SELECT discount_value, total_price, installments, installment_price, is_in_stock,
  nullif(concat_ws('|', discount_campaigns, discount_experiment_variant), '') AS discounts
FROM raw_rows WHERE k % 6 <> 1
""")
def _(spark, sf):
    return _item_rows(spark, sf).select(
        *[F.col(f"item.{n}").try_cast("decimal(10,2)").alias(n) for n in ("discount_value", "total_price", "installment_price")],
        F.col("item.installments").cast("int").alias("installments"),
        F.col("item.is_in_stock").cast("boolean").alias("is_in_stock"),
        "item.discounts",
    )


@query("P4_event_id", f"SELECT {_ID} AS generated_id, event_id AS source_id FROM stg")
def _(spark, sf):
    rows = stg(spark, sf).withColumn("micros", F.unix_micros(F.col("event_timestamp").cast("timestamp")))
    return rows.select(
        ga4.event_id("micros", "user_id", "event_name", "product_id").alias("generated_id"),
        F.col("event_id").alias("source_id"),
    )


@query("P5_split_discounts", """
SELECT event_id, discount_campaigns AS campaigns, discount_experiment_variant AS experiment_variant FROM stg
""")
def _(spark, sf):
    codes = F.concat_ws("|", "discount_experiment_variant", "discount_campaigns")
    return stg(spark, sf).select("event_id", ga4.split_discounts(codes, "XP_").alias("d")).select("event_id", "d.*")


@query("P6_flatten_events", f"SELECT {_FLAT.replace('event_timestamp,', 'CASE WHEN k <> 96 THEN event_timestamp END AS event_timestamp,', 1)} FROM raw_rows")
def _(spark, sf):
    return _flat_columns(flat(spark, sf))


@query("P7_items_as_list", """
SELECT event_name, product_id, price, CAST(price * quantity AS DECIMAL(18,2)) AS line FROM raw_rows WHERE k % 6 = 1
""")
def _(spark, sf):
    good, _ = ev.split_parsed(_parsed(spark, sf))
    listed = good.filter(F.col("items").startswith('[{"'))
    return ingest.flatten_events(listed, RUN_TS).select(
        "event_name", "product_id", "price", (F.col("price") * F.col("quantity")).cast("decimal(18,2)").alias("line")
    )


@query("P8_validate", "SELECT * FROM raw_good")
def _(spark, sf):
    return _flat_columns(ingest.validate(flat(spark, sf))[0])


@query("P9_parse_metrics", """
SELECT count(*) AS lines, count(*) FILTER (k <> 97) AS parsed_ok, count(*) FILTER (k = 97) AS parse_dead FROM canon
""")
def _(spark, sf):
    return ingest.parse_metrics(_parsed(spark, sf))


@query("P10_backfill", """
SELECT event_id, product_id, 'Cat ' || (k % 6) AS product_category_1,
  CAST(NULL AS VARCHAR) AS product_category_2, CAST(NULL AS VARCHAR) AS coupon FROM raw_rows WHERE k <> 96
""")
def _(spark, sf):
    good, _ = ingest.validate(flat(spark, sf))
    fields = ("product_category_1", "product_category_2", "coupon")
    return backfill.backfill(good, fields).select("event_id", "product_id", *fields)


@query("P11_backfill_field", """
SELECT 'Cat ' || (k % 6) AS category, product_id, count(*) AS items FROM raw_rows GROUP BY 1, 2
""")
def _(spark, sf):
    good, _ = ev.split_parsed(_parsed(spark, sf))
    texts = good.select(F.explode(ingest.item_texts(F.col("items"))).alias("t"))
    return texts.groupBy(
        ga4.item_field("t", "item_category").alias("category"),
        ga4.item_field("t", "item_id").alias("product_id"),
    ).agg(F.count(F.lit(1)).alias("items"))


@query("P12_backfill_stats", """
SELECT 'product_category_1' AS field, count(*) AS total_rows, count(*) AS rows_needing_backfill,
  count(*) AS null_rows, count(*) AS values_found FROM raw_rows WHERE k <> 96
UNION ALL
SELECT 'coupon', count(*), count(*), count(*), 0 FROM raw_rows WHERE k <> 96
""")
def _(spark, sf):
    good, _ = ingest.validate(flat(spark, sf))
    return backfill.backfill(good, ("product_category_1", "coupon"), dry_run=True)


def _sessions_of_parts(spark, sf, delay, *parts):
    """The staged events as a stream of one micro-batch for each condition; returns its folder and its rows' schema.

    A part is written by all tasks and drained before the next one arrives.
    """
    rows = lookups.resolve_platform(staged(read(spark, sf, "events")), lookups.dim_platforms(spark))
    folder, root, mark = (scratch_dir(spark, name) for name in ("parts", "sessions", "mark"))
    for n, part in enumerate(parts):
        rows.filter(part).write.parquet(f"{folder}/part={n}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/part=*").drop("part")
        streamed.sessionize_stream(stream, root, mark, MINUTES, delay)
    return root, rows.schema


_STREAMED = """user_id, platform_id, session_start_ts, session_end_ts, CAST(events_in_session AS BIGINT) AS events_in_session,
  CAST(views AS BIGINT) AS views, CAST(checkouts AS BIGINT) AS checkouts, CAST(purchases AS BIGINT) AS purchases"""

# Three parts in order of time; the watermark after the last is its greatest time less an hour.
@query("E5_sessionize_stream", f"""
SELECT {_STREAMED}, session_end_ts + INTERVAL '{MINUTES} minutes' <
    (SELECT max(event_timestamp) FROM facts WHERE user_id IS NOT NULL AND platform_id IS NOT NULL) - INTERVAL 1 hour AS is_closed
FROM usess
""")
def _(spark, sf):
    ts = F.col("event_timestamp")
    weeks = ts < "2024-01-11", (ts >= "2024-01-11") & (ts < "2024-01-21"), ts >= "2024-01-21"
    root, _ = _sessions_of_parts(spark, sf, "1 hour", *weeks)
    closed = streamed.closed_sessions(spark, root).withColumn("is_closed", F.lit(True))
    return closed.unionAll(streamed.open_sessions(spark, root, MINUTES).withColumn("is_closed", F.lit(False)))


# A third of the events of the first weeks arrives after everything else: what lies behind the watermark is kept apart.
fragment("in_time", """
SELECT *, CAST(event_id AS BIGINT) % 3 = 0 AND event_timestamp < TIMESTAMP '2024-01-21' AS held_back,
  max(event_timestamp) FILTER (user_id IS NOT NULL AND platform_id IS NOT NULL
    AND NOT (CAST(event_id AS BIGINT) % 3 = 0 AND event_timestamp < TIMESTAMP '2024-01-21')) OVER () - INTERVAL 14 days AS watermark
FROM facts
""")
fragment("in_time_usess", frag.sessions_sql(f"({frag.sessionized_sql('(SELECT * FROM in_time WHERE NOT held_back OR event_timestamp >= watermark)')})"))


@query("E5_late_rows", f"""
SELECT {_STREAMED}, CAST(NULL AS VARCHAR) AS event_id FROM in_time_usess
UNION ALL
SELECT user_id, platform_id, event_timestamp, event_timestamp, 1, CAST(event_name = 'view_item' AS BIGINT),
  CAST(event_name = 'begin_checkout' AS BIGINT), CAST(event_name = 'purchase' AS BIGINT), event_id
FROM in_time WHERE held_back AND event_timestamp < watermark AND user_id IS NOT NULL AND platform_id IS NOT NULL
""")
def _(spark, sf):
    held_back = (F.col("event_id").cast("long") % 3 == 0) & (F.col("event_timestamp") < "2024-01-21")
    root, schema = _sessions_of_parts(spark, sf, "14 days", ~held_back, held_back)
    sessions = streamed.closed_sessions(spark, root).unionAll(streamed.open_sessions(spark, root, MINUTES))
    ts = F.col("event_timestamp")
    ones = [F.lit(1).cast("long").alias("events_in_session")] + [
        (F.col("event_name") == e).cast("long").alias(c)
        for e, c in (("view_item", "views"), ("begin_checkout", "checkouts"), ("purchase", "purchases"))
    ]
    late = streamed.late_rows(spark, root, schema).select(
        "user_id", "platform_id", ts.alias("session_start_ts"), ts.alias("session_end_ts"), *ones, "event_id"
    )
    return sessions.withColumn("event_id", F.lit(None).cast("string")).unionByName(late)


fragment("raw_facts", """
SELECT r.*, p.platform_id, CAST(event_timestamp AS DATE) AS date_id, discount_campaigns AS campaign_codes,
  discount_experiment_variant AS experiment_id
FROM raw_good r LEFT JOIN platforms p ON upper(r.platform) = p.platform_name
""")
fragment("raw_sess", frag.sessionized_sql("raw_facts"))
fragment("raw_usess", frag.sessions_sql("raw_sess"))
fragment("raw_cart", frag.cart_sql("raw_usess", "raw_facts"))
fragment("raw_feat", frag.features_sql("raw_usess", "raw_cart", frag.THRESHOLD))
_RAW_FEATURES = """
SELECT * REPLACE (array_to_string(cart_products, ',') AS cart_products, CAST(cart_value AS DECIMAL(12,2)) AS cart_value)
FROM raw_feat
"""


def _stored_features(wh):
    return wh.table("silver_session_features").withColumn("cart_products", F.array_join("cart_products", ","))


@query("T1_run_silver_stream", _RAW_FEATURES)
def _(spark, sf):
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    jobs.run_pipeline_stream(wh, ev.stream_events(spark, raw_files(spark, sf)), scratch_dir(spark, "mark"), OPTIONS)
    return _stored_features(wh)


#: Fragments over staged events, read over the rows of the raw lines instead.
_RAW = {"stg": "raw_good", "facts": "raw_facts", "sess": "raw_sess", "usess": "raw_usess", "cart": "raw_cart", "feat": "raw_feat"}
_REBASED = ("imps", "attr", "ctouch", "bought", "pday", "dprod", "codes", "dcamp", "code_days", "fpc", "pdaily")


def over_raw(sql: str) -> str:
    names = _RAW | {n: f"raw_{n}" for n in _REBASED}
    return re.sub(r"\b(FROM|JOIN)( +)(\w+)", lambda m: m[1] + m[2] + names.get(m[3], m[3]), sql)


for _name in _REBASED:
    fragment(f"raw_{_name}", over_raw(FRAGMENTS[_name]))


def late_mixed(spark, sf):
    """A warehouse of all raw lines in three micro-batches that each hold events of all days, the same for all queries."""
    key = (spark.sparkContext.applicationId, sf, "late mixed")
    if key not in _WRITTEN:
        wh = Warehouse(spark, scratch_dir(spark, "wh"))
        events = read(spark, sf, "events")
        for n in range(3):
            part = raw_lines(spark, sf, events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == n)).withColumn("filepath", F.lit("raw"))
            jobs.ingest_batch(wh, part, OPTIONS, load=f"part-{n}")
        _WRITTEN[key] = wh
    return _WRITTEN[key]


@query("T1_incremental", _RAW_FEATURES)
def _(spark, sf):
    return _stored_features(late_mixed(spark, sf))


@query("T1_incremental_attribution", """
SELECT event_id, session_start_ts, item_list_id, impression_ts_chosen FROM raw_attr WHERE item_list_id IS NOT NULL
""")
def _(spark, sf):
    stored = late_mixed(spark, sf).table("silver_event_list_attribution")
    return stored.select("event_id", "session_start_ts", "item_list_id", "impression_ts_chosen")


@query("T1_incremental_campaign_touch", "SELECT * FROM raw_ctouch")
def _(spark, sf):
    return late_mixed(spark, sf).table("silver_session_campaign_last_touch").drop("updated_at", "session_date")


@query("T1_incremental_product_campaigns", "SELECT * FROM raw_fpc")
def _(spark, sf):
    return late_mixed(spark, sf).table("fct_product_campaigns")


@query("T1_incremental_product_daily", "SELECT * FROM raw_pdaily")
def _(spark, sf):
    return late_mixed(spark, sf).table("fct_product_daily_performance")


@query("T1_incremental_dim_products", """
SELECT product_id, product_name, price, effective_start_date, effective_end_date, is_active FROM raw_dprod
""")
def _(spark, sf):
    return late_mixed(spark, sf).table("dim_products").drop("product_sk", "product_category")


@query("T1_incremental_dim_campaigns", "SELECT campaign_id, campaign_name, effective_start_date, is_active FROM raw_dcamp")
def _(spark, sf):
    dim = late_mixed(spark, sf).table("dim_campaigns")
    return dim.select("campaign_id", "campaign_name", "effective_start_date", "is_active")


@query("T2_run_gold", f"""
SELECT session_date AS date, platform_id, count(*) AS sessions, count(*) FILTER (is_bounce) AS bounced,
  count(*) FILTER (is_abandoned_checkout) AS abandoned, CAST(sum(events_in_session) AS BIGINT) AS total_events
FROM raw_feat GROUP BY 1, 2
""")
def _(spark, sf):
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    good, _ = ingest.validate(flat(spark, sf))
    ev.append_staging(good, wh.path("stg_events"))
    run_silver(wh, OPTIONS)
    gold = run_gold(wh, "2024-01-30", options=OPTIONS)
    day = [F.col("session_date").alias("date"), "platform_id"]

    def sessions_of(name, alias):
        return gold[name].groupBy(*day).agg(F.count(F.lit(1)).alias(alias))

    keys = ["date", "platform_id"]
    return (
        gold["platform_daily"].select(*keys, "sessions", "total_events")
        .join(sessions_of("segment_bounce", "bounced"), keys, "left")
        .join(sessions_of("segment_checkout_abandon", "abandoned"), keys, "left")
        .select(*keys, "sessions", F.coalesce("bounced", F.lit(0)).alias("bounced"),
                F.coalesce("abandoned", F.lit(0)).alias("abandoned"), "total_events")
    )
