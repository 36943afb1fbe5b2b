"""The registered queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, decontaminate, langid, packing, pfparse, quality, reputation, runs, secret_scan, simhash, toxicity, trie
from .common import fold, stored, table

QUERIES: dict = {}
SQL: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


SQL["op8_decontaminate"] = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 10) AS n FROM item_words WHERE len(w) > 0),
item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, list_aggregate(w[i : i + 9], 'string_agg', ' ') AS window_text
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_windows AS (
    SELECT doc_id, n, i, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS window_text
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, window_text)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(F.filter("secrets", lambda x: x["kind"] != "random")), 256).alias("base_sha256"),
        listed("secrets").alias("spans"),
    )


@query
def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def lessons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that may be learnt from."""
    return table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, lessons(spark, sf_dir), "toxic"))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stored(quality.with_features(table(spark, sf_dir, "documents").select("doc_id", "text")), "features")
    scored = quality.score_features(docs, quality.fit_features(docs, lessons(spark, sf_dir), "quality"))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.KEEP_AT).cast("int").alias("predicted"),
    )


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(fold("doc_id", 3) != 1))
    return langid.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled page is bad if the document of its number is of low quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = reputation.judge(table(spark, sf_dir, "pages"), labels, rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _shrunk(children: str, parents: str, key: str, parent: str) -> str:
    return f"""
    SELECT *, mean * (1 - mean) / (k + n + 1) + (k / (k + n)) ** 2 * prior_doubt AS doubt FROM (
    SELECT {key}, {parent}, n, bad, k, prior_doubt, (k * prior + bad) / (k + n) AS mean FROM (
        SELECT c.*, p.mean AS prior, p.doubt AS prior_doubt,
               1 / greatest({reputation.LEAST_RHO}, least({reputation.MOST_RHO}, coalesce(
                   sum(CASE WHEN c.n > 0 THEN (c.bad - c.n * p.mean) ** 2 / c.n - p.mean * (1 - p.mean) END) OVER ()
                   / nullif(sum(CASE WHEN c.n > 0 THEN p.mean * (1 - p.mean) * (c.n - 1) END) OVER (), 0),
                   {reputation.MOST_RHO}))) - 1 AS k
        FROM {children} c JOIN {parents} p USING ({parent})))"""


SQL["op6_url_filter"] = rf"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
seen AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{reputation.UPPER}', '{reputation.LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules (rule_host, rule_path, rule_verdict) AS (VALUES {', '.join(map(str, RULES))}),
fits AS (
    SELECT DISTINCT ON (host, path) host, path, rule_host || rule_path AS rule, rule_verdict
    FROM (SELECT DISTINCT host, path FROM seen), rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    ORDER BY host, path, length(rule_host || rule_path) DESC),
outcomes AS (
    SELECT host, CASE WHEN l.doc_id IS NULL THEN NULL WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS bad
    FROM seen LEFT JOIN labels l ON l.doc_id = page_id),
hosts AS (
    SELECT host, array_to_string(parts[-2:], '.') AS domain, n, bad FROM (
        SELECT host, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS parts, count(bad) AS n,
               coalesce(sum(bad), 0) AS bad FROM outcomes GROUP BY 1)),
domains AS (SELECT domain, string_split(domain, '.')[-1] AS suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1),
suffixes AS (SELECT suffix, 0 AS whole, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY 1),
everything AS (
    SELECT whole, mean, mean * (1 - mean) / (n + 3) AS doubt
    FROM (SELECT whole, sum(n) AS n, (sum(bad) + 1) / (sum(n) + 2) AS mean FROM suffixes GROUP BY 1)),
suffix_scores AS ({_shrunk('suffixes', 'everything', 'suffix', 'whole')}),
domain_scores AS ({_shrunk('domains', 'suffix_scores', 'domain', 'suffix')}),
host_scores AS ({_shrunk('hosts', 'domain_scores', 'host', 'domain')})
SELECT s.page_id, s.host, s.path, f.rule,
       coalesce(f.rule_verdict, CASE WHEN h.mean - {reputation.Z} * sqrt(h.doubt)
                                          > {reputation.BAD_RATE} THEN 'block' ELSE 'allow' END) AS verdict
FROM seen s JOIN host_scores h USING (host) LEFT JOIN fits f ON f.host = s.host AND f.path = s.path
"""


@query
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = ann.build_index(rows, "vec_id", "embedding", copies=6)
    return ann.nearest(index, rows.where(F.col("vec_id") % 50 == 0), "vec_id", "embedding", k=5)


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = pfparse.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return kept.select(
        "doc_id",
        F.col("bytes").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def with_loops(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``; one text in ten, chosen by its id, repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def looped(words):
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        rounds = F.ceil((n - a) / p).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), rounds))
        return F.when(n > 0, F.array_join(F.slice(F.concat(F.slice(words, 1, a.cast("int")), tail), 1, n), " "))

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # The words are the one element of an array, so that they are taken once.
    text = F.when(h % 10 == 0, F.transform(F.array(words), looped)[0]).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_loops(table(spark, sf_dir, "documents")))
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, bpe.fit(docs), keep_text=False, decoded="decoded")
    return coded.select(
        "doc_id",
        F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations (conv_id, turns) with their first turns exchanged for those of the one whose id ends their five."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    heads = convs.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    joined = convs.join(heads, F.expr("conv_id - conv_id % 5") == F.col("base"), "left")
    head = F.coalesce(F.slice("head", 1, h), F.slice("turns", 1, 0))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


@query
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(rebuilt(trie.ordered_turns(table(spark, sf_dir, "conversations"))))
