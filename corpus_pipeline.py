"""From documents to packed training sequences.

Each stage takes all that the one before kept, written as Parquet and read again. All but the last return the columns
of ``documents`` as they came, extra ones included; NULL texts pass the filters, as nothing is found in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, packing, queries, secret_scan, simhash, toxicity
from tidemark.llm.common import free_name, stored, table

#: SQL cannot express the classifier, the sketches or the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, learnt from the labels of ``sf_dir``, finds toxic (0.5 or more)."""
    learnt = toxicity.fit(table(spark, sf_dir, "documents"), queries.lessons(spark, sf_dir), "toxic")
    name = free_name(docs, "toxicity")
    return toxicity.score(docs, learnt, name=name, keep_text=True).where(F.col(name) < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of texts with five-word shingles of similarity 0.8 or more."""
    return simhash.without_copies(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words of a benchmark item, or all words of a shorter one."""
    key = free_name(docs, "digest")
    keyed = docs.withColumn(key, F.md5(F.col("text").cast("binary")))
    hits = decontaminate.contamination(keyed, table(spark, sf_dir, "benchmark"), id_col=key, slop=0)
    found = hits.where(F.size("spans") > 0).select(key).distinct()
    return keyed.join(found, key, "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; ``n_chars`` counts the new text."""
    name = free_name(docs, "secrets")
    found = secret_scan.secrets(docs, name=name)
    masked = found.withColumn("text", secret_scan.redacted(F.col("text"), F.col(name)))
    n_chars = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
