"""One row per business key out of the append-only loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Newest row per non-null key, by ``order_by`` descending with NULLs first.

    Columns not named break remaining ties, so the choice is the same on every
    run. The row_number filter is pushed below the shuffle: each task sends at
    most one row per key, which keeps a repeated key from filling one task.
    """
    rest = sorted(set(df.columns) - set(order_by) - {key})
    order = [F.col(c).desc_nulls_first() for c in [*order_by, *rest]]
    newest = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rn", newest)
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


NEWEST_LOAD = ["ingested_at", "run_date"]


def orders_view(latest: DataFrame) -> DataFrame:
    return latest.select(
        "order_id", "merchant_id", "customer_vpa", "amount", "status",
        "created_at", "updated_at", "run_date",
    )


def gateway_view(latest: DataFrame) -> DataFrame:
    return latest.select(
        "txn_id", "order_id", "gateway_status", "amount", "event_time", "event_type", "run_date",
    )


def settlements_view(latest: DataFrame) -> DataFrame:
    return latest.select(
        "settlement_id", "txn_id", "gross_amount", "mdr_fee", "gst_on_fee", "net_settled",
        "settled_date", F.coalesce("settlement_type", F.lit("payment")).alias("settlement_type"),
        "run_date",
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return orders_view(latest_by(raw, "order_id", NEWEST_LOAD))


def stg_gateway_events(raw: DataFrame) -> DataFrame:
    return gateway_view(latest_by(raw, "txn_id", NEWEST_LOAD))


def stg_settlements(raw: DataFrame) -> DataFrame:
    return settlements_view(latest_by(raw, "settlement_id", NEWEST_LOAD))


def _greater(a: str, b: str, key: str, columns: list[str]) -> Column:
    """Of two packed rows of a key the one that ``latest_by`` would choose; a missing one is not chosen."""
    order = [*NEWEST_LOAD, *sorted(set(columns) - set(NEWEST_LOAD) - {key})]

    def rank(row: str) -> Column:
        # NULLs first in descending order.
        return F.struct(*[f for c in order for f in (F.col(f"{row}.{c}").isNull(), F.col(f"{row}.{c}"))])

    return F.when(F.col(b).isNull() | (F.col(a).isNotNull() & (rank(a) >= rank(b))), F.col(a)).otherwise(F.col(b))


def advanced(
    held: DataFrame, today: DataFrame, earlier: DataFrame, keys: DataFrame, key: str, run_date
) -> DataFrame:
    """(key, old, new, touched) of every row of ``held`` and every one of ``keys``: the newest row so far, only
    named where it is ``touched`` (one of ``keys``), and the newest brought forward by a day's load.

    ``held`` has one row per key. If the day replaces an earlier load of itself, rows that came
    from that load do not count any more, and ``earlier``, the loads of all other days, says
    what was newest before them; it is read only for keys whose row is lost that way.
    """
    replaced = F.col("run_date").eqNullSafe(F.lit(run_date))
    lost = held.where(replaced).select(key).join(keys, key, "left_semi")
    fresh = latest_by(today.unionByName(earlier.join(lost, key, "left_semi")), key, NEWEST_LOAD)
    come = keys.join(fresh.select(key, F.struct(*held.columns).alias("come")), key, "left").withColumn("touched", F.lit(True))
    met = held.select(key, F.struct(*held.columns).alias("old")).join(come, key, "full")
    met = met.withColumns({
        "touched": F.coalesce("touched", F.lit(False)),
        "stays": F.when(~F.coalesce(F.col("touched"), F.lit(False)) | ~F.col("old.run_date").eqNullSafe(F.lit(run_date)), F.col("old")),
    })
    return met.select(key, F.when(F.col("touched"), F.col("old")).alias("old"), _greater("stays", "come", key, held.columns).alias("new"), "touched")
