"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Collecting a Python stack trace per column expression costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Merge session windows inside each map task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def get_spark(app: str = "tidemark", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="spark-tidemark-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
