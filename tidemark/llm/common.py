"""What the operators share: scratch tables, folds and Arrow column access."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import scratch_dir

#: Bytes of text handled at once inside a task; bounds what numpy allocates.
SLICE_BYTES = 4_000_000

#: Maps A-Z to a-z in UTF-8 bytes and leaves all else.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a bucket, and the most buckets Spark writes by default; beyond that buckets grow.
BUCKET_BYTES, MOST_BUCKETS = 64_000_000, 100_000


def bucketed(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """``df`` stored in the shared scratch folder in buckets of ``key``: later joins on it move only their other side.

    There are as many buckets as the bytes of the column ``text`` ask for, and no fewer than shuffle partitions. The
    session's catalog knows the table only while it is written and opened.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES)))
    made = f"{name}_{path[-32:]}"
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(made)
    opened = spark.table(made)
    # The files are the table's own folder and stay; the frame has their list and the buckets already.
    spark.sql(f"DROP TABLE `{made}`")
    return opened


#: Keys that are looked up without a shuffle: each is in more than this share of the rows, so they are fewer.
FREQUENT_KEYS = 4096


def having(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is in ``keys``, which has each key once and in ``n`` how many of the rows have it, with ``n``.

    Rows of a frequent key are found where they lie, by a broadcast of the frequent keys; the others are joined by a
    shuffle, in which no key has more than one in ``FREQUENT_KEYS`` rows. Both frames are read more than once.
    """
    limit = (keys.agg(F.sum("n")).first()[0] or 0) // FREQUENT_KEYS
    frequent = F.broadcast(keys.where(F.col("n") > limit).select(key, "n"))
    others = rows.join(frequent, key, "left_anti").join(keys.where(F.col("n") <= limit).select(key, "n"), key)
    return rows.join(frequent, key).unionAll(others)


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def byte_column(col: pa.Array) -> list[bytes]:
    """Values of a binary column, b'' for NULL."""
    return [v or b"" for v in col.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds about ``limit`` bytes of its binary column ``text`` or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(text)
        off = np.frombuffer(col.buffers()[1], dtype=np.int32 if pa.types.is_binary(col.type) or pa.types.is_string(col.type) else np.int64)
        off = off[col.offset : col.offset + n + 1].astype(np.int64)
        start = 0
        while start < n:
            end = max(start + 1, int(np.searchsorted(off, off[start] + limit, side="right")) - 1)
            yield batch.slice(start, min(end, n) - start)
            start = min(end, n)


def from_texts(docs: DataFrame, text_col: str, ddl: str, make: Callable[[], Callable], keep_text: bool = True) -> DataFrame:
    """``docs`` with the columns of ``ddl`` computed from its text by Arrow batches.

    ``make()`` runs once a task and returns a function from a list of UTF-8 texts (b'' for NULL) to one Arrow array
    per new column; it gets a few MB of text at a time. Other columns pass through as they are, whatever their names;
    a column that has the name of a new one is replaced.
    """
    new = StructType.fromDDL(ddl)
    gone = {n.lower() for n in new.names} | (set() if keep_text else {text_col.lower()})
    row, text = free_name(docs, "row"), free_name(docs, "bytes")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in gone]
    inner = docs.select(F.struct(*kept).alias(row), F.col(text_col).cast("binary").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for part in slices(batches):
            values = compute(byte_column(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), *values], [row, *new.names])

    out = inner.mapInArrow(run, StructType([inner.schema[row], *new.fields]))
    return out.select(f"{row}.*", *[F.col(n) for n in new.names])


def labelled(rows: DataFrame, labels: DataFrame, key_col: str, label_col: str) -> tuple[DataFrame, dict[int, int]]:
    """Stored (label, ...) of all ``rows`` (key, ...) with a label, and how many there are of each label.

    Labels are 0 and 1; other labels, NULL keys and labels without a row teach nothing. The rows are shuffled whatever
    the size of ``labels``, so that the work grows with the input alone.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(key_col).alias("key"), F.col(label_col).cast("int").alias("label"))
    joined = rows.hint("merge").join(known.distinct(), "key")
    kept = stored(joined.select("label", *[c for c in rows.columns if c != "key"]), "labelled")
    return kept, {r["label"]: r["n"] for r in kept.groupBy("label").agg(F.count("*").alias("n")).collect()}


def summed(rows: DataFrame, size: int, make: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of the arrays of ``size`` numbers that ``make`` gives for the batches; the driver gets one a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                total += make(batch.slice(a, 1000))
        part = pa.array([TaskContext.get().partitionId()], pa.int32())
        yield pa.RecordBatch.from_arrays([part, pa.array([total], pa.list_(pa.float64()))], ["part", "total"])

    got = rows.mapInArrow(run, "part int, total array<double>").toArrow().sort_by("part").combine_chunks()
    # In the order of the tasks, so that the last digits do not depend on which ended first.
    return got["total"].combine_chunks().flatten().to_numpy().reshape(-1, size).sum(axis=0)


def nth_least(values: DataFrame, name: str, nth: int, bins: int = 1000, most: int = 10_000) -> float:
    """The exact value of rank ``nth`` (from 0) of a column of finite doubles, by counts in ever narrower ranges."""
    value = F.col(name)
    bounds = F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n")
    found, before = values.agg(*bounds).first(), 0
    while found["low"] < found["high"]:
        inside = values.where(value.between(found["low"], found["high"]))
        if found["n"] <= most:
            return sorted(r[0] for r in inside.select(value).collect())[nth - before]
        place = F.least(F.floor((value - found["low"]) / ((found["high"] - found["low"]) / bins)), F.lit(bins - 1))
        for found in sorted(inside.groupBy(place.alias("bin")).agg(*bounds).collect()):
            if before + found["n"] > nth:
                break
            before += found["n"]
    return found["low"]
