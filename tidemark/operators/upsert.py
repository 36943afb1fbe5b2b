"""Insert and upsert rules as DataFrame expressions (no MERGE needed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row per key, the greatest by ``order`` and then by the other columns; map-side combined."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("best")
    return (
        df.groupBy(*keys)
        .agg(best)
        .select(*[F.col(c) if c in keys else F.col(f"best.{c}").alias(c) for c in df.columns])
    )


def append_new(target: DataFrame, rows: DataFrame, keys: list) -> DataFrame:
    """The rows to append: one per key, none whose key the target holds."""
    return rows.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti").select(*rows.columns)


def upsert_replace(target: DataFrame, updates: DataFrame, keys: list) -> DataFrame:
    """Updates win; ``updates`` is unique by key."""
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))


def upsert_additive(
    target: DataFrame, updates: DataFrame, keys: list, sums=(), mins=(), maxs=()
) -> DataFrame:
    """Counters add up, first and last dates widen."""
    types = {f.name: f.dataType for f in target.schema.fields}
    return (
        target.unionByName(updates.select(*target.columns))
        .groupBy(*keys)
        .agg(
            *[F.sum(c).cast(types[c]).alias(c) for c in sums],
            *[F.min(c).alias(c) for c in mins],
            *[F.max(c).alias(c) for c in maxs],
        )
        .select(*target.columns)
    )
