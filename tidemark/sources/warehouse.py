"""Parquet tables of the pipeline.

Four kinds of table:

* ``snapshot``: small tables written whole into ``run_seq=N``; readers take the newest committed run.
* ``delta``: additive rows of each run under ``run_seq=N``; readers roll all committed runs up. Every
  ``COMPACT_EVERY`` runs the roll-up is stored under ``base_seq=N`` and later runs are added to that.
* ``dated``: facts and staging, appended under the date they belong to.
* ``bucketed``: session tables in parts (session date, bucket of the actor). A run writes the parts it touches, whole,
  under its own ``run_seq=N``; the snapshot ``session_parts`` lists which run holds each part. Readers read the parts of
  one commit by their paths, so tables that a run has replaced only in part are never seen together.

A run with sequence N is committed when its ``etl_checkpoints`` snapshot exists. A run that died before
that is repeated under the same N and overwrites what it left behind.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import facts
from tidemark.operators.scd import conform
from tidemark.operators.sessions import ACTOR
from tidemark.sources.files import delete, file_system, matching

SNAPSHOTS = {
    "dim_users": schemas.DIM_USERS,
    "dim_products": schemas.DIM_PRODUCTS,
    "dim_item_lists": schemas.DIM_ITEM_LISTS,
    "dim_campaigns": schemas.DIM_CAMPAIGNS,
    "dim_experiments": schemas.DIM_EXPERIMENTS,
    "session_parts": schemas.SESSION_PARTS,
    "etl_checkpoints": schemas.CHECKPOINTS,
}
DELTAS = {
    "product_days": schemas.PRODUCT_DAYS,
    "fct_product_daily_performance": schemas.PRODUCT_DAILY,
    "product_campaign_days": schemas.PRODUCT_CAMPAIGN_DAYS,
}
BUCKETED = {
    "silver_user_sessions": schemas.USER_SESSIONS,
    "silver_session_features": schemas.SESSION_FEATURES,
    "silver_list_impressions": schemas.LIST_IMPRESSIONS,
    "silver_event_list_attribution": schemas.LIST_ATTRIBUTION,
    "silver_session_campaign_last_touch": schemas.CAMPAIGN_TOUCH,
}


COMPACT_EVERY = 50
KEEP_SNAPSHOTS = 5


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, session_buckets: int = 4):
        """``session_buckets``: parts of a session date; the more, the less a late event of one user rewrites."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.session_buckets = session_buckets

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, path: str) -> bool:
        fs, p = file_system(self.spark, path)
        return fs.exists(p)

    def _runs(self, name: str, label: str = "run_seq") -> list:
        """Finished run folders of a table."""
        fs, p = file_system(self.spark, self.path(name))
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        seqs = [int(n.split("=")[1]) for n in names if n.startswith(f"{label}=")]
        return sorted(n for n in seqs if self.exists(f"{self.path(name)}/{label}={n}/_SUCCESS"))

    def committed(self) -> int:
        """Sequence of the last committed run, 0 before the first."""
        return max(self._runs("etl_checkpoints"), default=0)

    def empty(self, schema) -> DataFrame:
        """No rows, in a form the optimizer can see through and drop from joins and unions."""
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return self.spark.range(1).select(*columns).limit(0)

    def table(
        self, name: str, upto: int | None = None, dates: list | None = None, parts: set | None = None, schema=None
    ) -> DataFrame:
        """Content of a table at a commit (the last one by default).

        ``dates`` (facts and staging) or ``parts`` (session tables) limit what is read, and even listed, to those.
        ``schema`` reads further columns of staging and the load each row belongs to.
        """
        if name == "stg_events":
            partitions = ["ingestion_date", "load"] if schema else ["ingestion_date"]
            return self._dated(name, schema or schemas.STG_EVENTS, partitions, dates)
        upto = self.committed() if upto is None else upto
        if name == "fct_events":
            events = self._dated(name, schemas.FCT_EVENTS, ["date_id", "run_seq"], dates)
            return events.filter(F.col("run_seq") <= upto).drop("run_seq")
        if name in SNAPSHOTS:
            runs = [n for n in self._runs(name) if n <= upto]
            if not runs:
                return self.empty(SNAPSHOTS[name])
            return self.spark.read.schema(SNAPSHOTS[name]).parquet(f"{self.path(name)}/run_seq={runs[-1]}")
        if name == "fct_product_campaigns":
            dims = (self.table("dim_campaigns", upto), self.table("dim_products", upto))
            return facts.priced_campaigns(self.table("product_campaign_days", upto), *dims)
        if name in DELTAS:
            return self._rolled_up(name, upto)
        if name in BUCKETED:
            found = [p for n, *p in self.session_parts(upto) if n == name and (parts is None or tuple(p[:2]) in parts)]
            paths = [f"{self.path(name)}/{part_path(seq, day, bucket)}" for day, bucket, seq in found]
            return self._read(name, BUCKETED[name], [], paths)
        raise ValueError(f"unknown table: {name}")

    def session_parts(self, upto: int | None = None) -> list[tuple]:
        """(table, session_date, bucket, run_seq) of every part at a commit: tables x calendar days x buckets at most."""
        return [tuple(r) for r in self.table("session_parts", upto).select("table", "session_date", "bucket", "seq").collect()]

    def _dated(self, name, schema, partitions, dates) -> DataFrame:
        root = self.path(name)
        if not self.exists(root):
            paths = []
        elif dates is None:
            paths = [root]
        else:
            wanted = {str(d) for d in dates}
            paths = [p for p in matching(self.spark, f"{root}/{partitions[0]}=*") if p.rsplit("=", 1)[1] in wanted]
        return self._read(name, schema, partitions, paths)

    def dates_since(self, name: str, column: str, first) -> list[str] | None:
        """Dates of a dated table from ``first`` on; None if all."""
        if first is None:
            return None
        found = [p.rsplit("=", 1)[1] for p in matching(self.spark, f"{self.path(name)}/{column}=*")]
        return [d for d in found if d >= str(first)]

    def _read(self, name: str, schema, partitions: list, paths: list[str]) -> DataFrame:
        extra = [p for p in partitions if p not in schema.names]
        types = {"run_seq": T.IntegerType(), "load": T.StringType()}
        full = T.StructType(schema.fields + [T.StructField(p, types.get(p, T.DateType())) for p in extra])
        if not paths:
            return self.empty(full)
        return self.spark.read.schema(full).option("basePath", self.path(name)).parquet(*paths).select(*full.names)

    def _rolled_up(self, name: str, upto: int) -> DataFrame:
        schema = DELTAS[name]
        base = max((n for n in self._runs(name, "base_seq") if n <= upto), default=0)
        paths = [f"{self.path(name)}/run_seq={n}" for n in self._runs(name) if base < n <= upto]
        if base:
            paths.append(f"{self.path(name)}/base_seq={base}")
        if not paths:
            return self.empty(schema)
        return roll_up(name, self.spark.read.schema(schema).parquet(*paths))

    def tidy(self, seq: int, compact_every: int = COMPACT_EVERY) -> None:
        """After run ``seq`` is committed: drop its work files, old snapshots and parts, compact deltas."""
        delete(self.spark, f"{self.path('_work')}/run_seq={seq}")
        self._drop_parts()
        for name in SNAPSHOTS:
            for n in self._runs(name)[:-KEEP_SNAPSHOTS]:
                delete(self.spark, f"{self.path(name)}/run_seq={n}")
        for name, schema in DELTAS.items():
            base = max(self._runs(name, "base_seq"), default=0)
            if len([n for n in self._runs(name) if base < n <= seq]) >= compact_every:
                rolled = self._rolled_up(name, seq)
                conform(rolled, schema).write.mode("overwrite").parquet(f"{self.path(name)}/base_seq={seq}")

    def _drop_parts(self) -> None:
        """Delete parts that no kept commit lists any more: those of a dropped list that its successor replaced."""
        runs = self._runs("session_parts")
        for old, following in list(zip(runs, runs[1:]))[: max(0, len(runs) - KEEP_SNAPSHOTS)]:
            for name, day, bucket, seq in set(self.session_parts(old)) - set(self.session_parts(following)):
                delete(self.spark, f"{self.path(name)}/{part_path(seq, day, bucket)}")

    def write_snapshot(self, name: str, df: DataFrame, seq: int) -> None:
        conform(df, SNAPSHOTS[name]).write.mode("overwrite").parquet(f"{self.path(name)}/run_seq={seq}")

    def write_delta(self, name: str, df: DataFrame, seq: int) -> None:
        conform(df, DELTAS[name]).write.mode("overwrite").parquet(f"{self.path(name)}/run_seq={seq}")

    def append_facts(self, events: DataFrame, seq: int) -> None:
        replace_partitions(
            conform(events, schemas.FCT_EVENTS).withColumn("run_seq", F.lit(seq)),
            self.path("fct_events"),
            ["date_id", "run_seq"],
        )

    def bucket(self) -> Column:
        """The bucket of a row's actor inside a session date."""
        return F.pmod(F.xxhash64(*ACTOR), F.lit(self.session_buckets)).cast("int")

    def write_parts(self, name: str, df: DataFrame, seq: int) -> None:
        """Write the new content of all parts that run ``seq`` touches."""
        rows = conform(df, BUCKETED[name]).withColumn("bucket", self.bucket())
        rows.hint("rebalance", "session_date", "bucket").write.mode("overwrite").partitionBy("session_date", "bucket").parquet(
            f"{self.path(name)}/run_seq={seq}"
        )

    def list_parts(self, touched: set, done: int, seq: int) -> None:
        """The parts at commit ``seq``: those of ``done`` that were not touched, and what was written."""
        kept = [p for p in self.session_parts(done) if (p[1], p[2]) not in touched]
        written = []
        for name in BUCKETED:
            for path in matching(self.spark, f"{self.path(name)}/run_seq={seq}/session_date=*/bucket=*"):
                *_, day, bucket = path.split("/")
                written.append((name, date.fromisoformat(day.split("=")[1]), int(bucket.split("=")[1]), seq))
        rows = [(*p, self.session_buckets) for p in kept + written]
        self.write_snapshot("session_parts", self.spark.createDataFrame(rows, schemas.SESSION_PARTS), seq)

    def check_buckets(self) -> None:
        """A warehouse keeps the number of buckets it began with."""
        made = self.table("session_parts").select("buckets").first()
        if made and made["buckets"] != self.session_buckets:
            raise ValueError(f"session tables have {made['buckets']} buckets, not {self.session_buckets}")


def part_path(seq: int, day, bucket: int) -> str:
    return f"run_seq={seq}/session_date={day}/bucket={bucket}"


def roll_up(name: str, rows: DataFrame) -> DataFrame:
    """Delta rows of several runs as one table."""
    if name == "product_days":
        best = F.max(F.struct("last_ts", "last_event_id", "product_name", "price")).alias("best")
        out = rows.groupBy("product_id", "event_date").agg(best).select("product_id", "event_date", "best.*")
        return out.select(*DELTAS[name].names)
    if name == "fct_product_daily_performance":
        keys = ["date_id", "product_id"]
    else:
        keys = ["product_id", "campaign_id", "day", "discount_value"]
    sums = [c for c in rows.columns if c not in keys]
    types = {f.name: f.dataType for f in DELTAS[name].fields}
    return (
        rows.groupBy(*keys)
        .agg(
            *[F.sum(c).cast(types[c]).alias(c) for c in sums],
        )
        .select(*DELTAS[name].names)
    )


def replace_partitions(df: DataFrame, path: str, partitions: list) -> None:
    """Overwrite exactly the partitions present in ``df``; repeating the write changes nothing.

    The rebalance hint lets AQE size the output files and split a day that holds most of the rows.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def drop_partitions(spark: SparkSession, path: str, column: str, values: list) -> None:
    """Delete the partitions of these values, where there are any."""
    for value in values:
        delete(spark, f"{path}/{column}={value}")
