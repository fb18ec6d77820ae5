"""Merchant history, the fee valid at a point in time, and the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.money import fee_split
from ledgerline.operators.skew import copy_to_salts, hot_keys, salt_rows


def chain_versions(history: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Type-2 rows from a full change history: each version ends where the next begins.

    The next change is looked up within the key's calendar day first, then across
    days over one row per key and day. So the only window over a whole key is as
    long as the calendar, however many changes the key has.
    """
    days = history.withColumn("_day", F.to_date(updated_at))
    in_day = Window.partitionBy(key, "_day").orderBy(updated_at)
    within = days.withColumn("_next", F.lead(updated_at).over(in_day))
    firsts = within.groupBy(key, "_day").agg(F.min(updated_at).alias("_first"))
    next_day = firsts.select(
        key, "_day", F.lead("_first").over(Window.partitionBy(key).orderBy("_day")).alias("_later"),
    )
    return (
        within.join(next_day, [key, "_day"], "left")
        .withColumns({
            "valid_from": F.col(updated_at),
            "valid_to": F.coalesce("_next", "_later"),
        })
        .select(*history.columns, "valid_from", "valid_to")
    )


def scd2_merge(snapshot: DataFrame, source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Next state of a type-2 table given the source as it stands now.

    A newer ``updated_at`` closes the current row and opens a new one; unknown keys
    are inserted; keys gone from the source and closed rows stay as they are. Closed
    history takes no part in the join.
    """
    cols = source.columns
    current = snapshot.where(F.col("valid_to").isNull()).select(
        F.struct(*snapshot.columns).alias("cur"), F.col(key).alias("_cur_key")
    )
    incoming = source.select(F.struct(*cols).alias("src"), F.col(key).alias("_src_key"))
    pairs = current.join(incoming, F.col("_cur_key") == F.col("_src_key"), "full_outer")

    src_time = F.col(f"src.{updated_at}")
    changed = src_time > F.col(f"cur.{updated_at}")

    def row(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in cols], start.alias("valid_from"), end.alias("valid_to")
        )

    open_end = F.lit(None).cast(source.schema[updated_at].dataType)
    kept = F.when(
        F.col("cur").isNotNull(), row("cur", F.col("cur.valid_from"), F.when(changed, src_time)),
    )
    opened = F.when(F.col("cur").isNull() | changed, row("src", src_time, open_end))
    merged = (
        pairs.select(F.explode(F.array(kept, opened)).alias("row")).where("row is not null").select("row.*")
    )
    closed = snapshot.where(F.col("valid_to").isNotNull()).select(*cols, "valid_from", "valid_to")
    return closed.unionByName(merged)


def dim_merchants(snapshot: DataFrame) -> DataFrame:
    """The published merchant dimension, one row per version."""
    return snapshot.select(
        "merchant_id", "name", "category", "fee_rate", "created_at", "updated_at",
        F.col("valid_from").alias("dbt_valid_from"), F.col("valid_to").alias("dbt_valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )


def fee_as_of(orders: DataFrame, snapshot: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Orders with the merchant's fee rate valid when they were placed.

    Versions and orders of a merchant are laid on one time line and the last version
    seen is carried forward, so no order meets every version of its merchant. Orders of
    a merchant holding a large share are spread over salts by that share, with its versions
    copied to each. Orders without a valid version keep a NULL rate.
    """
    hot = hot_keys(orders, "merchant_id") if hot is None else hot
    placed = salt_rows(orders, "merchant_id", hot, "order_id").withColumns({
        "_at": F.col("created_at"), "_is_order": F.lit(1),
    })
    versions = copy_to_salts(snapshot, "merchant_id", hot).select(
        "merchant_id", "_salt", F.col("valid_from").alias("_at"), F.lit(0).alias("_is_order"),
        F.struct("fee_rate", "valid_to").alias("_version"),
    )
    line = Window.partitionBy("merchant_id", "_salt").orderBy("_at", "_is_order").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    carried = (
        placed.unionByName(versions, allowMissingColumns=True)
        .withColumn("_v", F.last("_version", ignorenulls=True).over(line))
        .where(F.col("_is_order") == 1)
    )
    still_valid = F.col("_v.valid_to").isNull() | (F.col("_at") < F.col("_v.valid_to"))
    return carried.select(*orders.columns, F.when(still_valid, F.col("_v.fee_rate")).alias("fee_rate"))


def settlement_fees(df: DataFrame, rate_col: str, gross_col: str = "gross_amount") -> DataFrame:
    """Add the fee, the tax on it and the net amount that the rate implies."""
    fee, tax, net = fee_split(F.col(gross_col), F.col(rate_col))
    return df.withColumns({"expected_mdr_fee": fee, "expected_gst_on_fee": tax, "expected_net_settled": net})


def calendar_columns(df: DataFrame, date_col: str = "date_day") -> DataFrame:
    """Calendar attributes of a date; names are padded to nine characters, weeks start on Monday."""
    d = F.col(date_col)
    weekday = F.weekday(d) + 1
    return df.withColumns({
        "year": F.year(d),
        "month": F.month(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": weekday,
        "day_name": F.rpad(F.date_format(d, "EEEE"), 9, " "),
        "month_name": F.rpad(F.date_format(d, "MMMM"), 9, " "),
        "quarter": F.quarter(d),
        "is_weekend": weekday.isin(6, 7),
    })


def dim_date(
    spark: SparkSession, start: dt.date = dt.date(2024, 1, 1), end: dt.date = dt.date(2030, 12, 31)
) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    days = F.explode(F.sequence(F.lit(start), F.lit(end), F.make_dt_interval(F.lit(1))))
    return calendar_columns(spark.range(1).select(days.alias("date_day")))
