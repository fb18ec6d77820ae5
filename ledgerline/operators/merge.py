"""Keyed replace and upsert as joins, for tables without row-level writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.skew import spread_join


def replace_keys(
    target: DataFrame, batch: DataFrame, key: str, spread_by: str | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """``target`` without the batch's keys, plus the batch.

    Only keys present in the batch are replaced. Pass a materialized batch when it
    is costly: it is read twice. ``key`` may repeat in the target.
    """
    keys = batch.select(key).distinct()
    return spread_join(target, keys, key, "left_anti", spread_by, hot).unionByName(batch)


def upsert(target: DataFrame, source: DataFrame, key: str, update_cols: list[str]) -> DataFrame:
    """Insert new keys whole; for known keys overwrite only ``update_cols``.

    ``key`` is unique on both sides. A NULL in the source does overwrite.
    """
    t = target.withColumn("_old", F.lit(True)).alias("t")
    s = source.withColumn("_new", F.lit(True)).alias("s")

    def merged(name: str):
        old, new = F.col(f"t.{name}"), F.col(f"s.{name}")
        take_new = F.col("_new") if name in update_cols else F.col("_old").isNull()
        return F.when(take_new, new).otherwise(old).alias(name)

    both = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    return both.select(*[merged(name) for name in target.columns])
