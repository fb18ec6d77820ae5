"""Joins that keep working when one key holds a large share of the rows.

AQE splits a skewed shuffle partition only when both join inputs come straight
from a shuffle. Here one side usually is an aggregate or a window, so the split
is written into the plan instead.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import shuffle_width

# A key is hot if its rows fill this part of a mean shuffle partition.
HOT_PART = 0.5
# Tables of sketches, and how many times the hot keys that fit into one it reports and follows.
_BUCKETS, _REPORTED, _FOLLOWED = 64, 4, 16
_LEAST_FOLLOWED = 256


def hot_share(df: DataFrame) -> float:
    """The share of all rows from which on a key is hot; the more partitions, the smaller."""
    return HOT_PART / shuffle_width(df.sparkSession)


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """(key, salts): keys holding at least ``share`` of the rows, never more than 1/share of
    them, and into how many parts of about that share each is split.

    Keys are hashed into buckets with one small frequent-items sketch each, so tasks
    exchange sketches and not keys, and the sketches are merged by as many tasks as
    there are buckets. Sketches grow with the number of hot keys there can be. The estimate
    decides only how rows are spread: its error costs balance and never a result row.
    """
    share = share or hot_share(df)
    expected = 1 / (share * _BUCKETS)
    reported = math.ceil(_REPORTED * expected) + _REPORTED
    followed = max(_LEAST_FOLLOWED, math.ceil(_FOLLOWED * expected))
    bucket = F.pmod(F.xxhash64(key), F.lit(_BUCKETS))
    per_bucket = (
        df.where(F.col(key).isNotNull())
        .groupBy(bucket.alias("bucket"))
        .agg(
            F.expr(f"approx_top_k({key}, {reported}, {followed})").alias("top"),
            F.count("*").alias("rows"),
        )
    )
    # One row with at most a few times 1/share items.
    total = per_bucket.agg(F.flatten(F.collect_list("top")).alias("top"), F.sum("rows").alias("rows"))
    top = total.select(F.explode("top").alias("top"), "rows")
    held = F.col("top.count") / F.col("rows")
    return top.where(held >= share).select(F.col("top.item").alias(key), F.ceil(held / share).cast("int").alias("salts"))


def _tag_hot(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    # Bounded by hot_keys at 1/share rows, a few for each partition, so this broadcast does not grow with the data.
    tags = F.broadcast(hot.select(F.col(key).alias("_hot"), F.col("salts").alias("_salts")))
    return df.join(tags, F.col(key) == F.col("_hot"), "left").drop("_hot")


def salt_rows(df: DataFrame, key: str, hot: DataFrame, spread_by: str | None) -> DataFrame:
    """Add ``_salt``: rows of a hot key are spread over the key's salts, NULL keys over as many
    as there are partitions, the rest get 0.

    The salt is a hash of ``spread_by`` (default: of the whole row), not a random
    number, so a repeated task puts every row where it was before.
    """
    source = [spread_by] if spread_by else df.columns
    salts = F.when(F.col(key).isNull(), F.lit(shuffle_width(df.sparkSession))).otherwise(F.coalesce("_salts", F.lit(1)))
    return _tag_hot(df, key, hot).withColumn("_salt", F.pmod(F.xxhash64(*source), salts).cast("int")).drop("_salts")


def copy_to_salts(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Add ``_salt``: rows of hot keys once per salt of the key, the rest once."""
    targets = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return _tag_hot(df, key, hot).withColumn("_salt", F.explode(targets)).drop("_salts")


def spread_join(
    left: DataFrame, right: DataFrame, key: str, how: str, spread_by: str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi join of a possibly skewed left side to a right side unique on ``key``.

    Only the right rows of hot keys are copied, one per salt.
    """
    hot = hot_keys(left, key) if hot is None else hot
    salted = salt_rows(left, key, hot, spread_by)
    copies = copy_to_salts(right, key, hot)
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def nulls_last(column: str) -> list[Column]:
    """Ascending order with NULLs at the end, as fields for a comparison struct."""
    return [F.col(column).isNull(), F.col(column)]
