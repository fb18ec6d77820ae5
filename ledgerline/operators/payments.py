"""Transaction-grain payments fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.reconcile import settled_gateway
from ledgerline.operators.skew import hot_keys, spread_join

PAYMENT_FACT_COLS = [
    "txn_id", "order_id", "gateway_status", "gateway_amount", "event_time", "event_type",
    "merchant_id", "order_status", "order_amount", "is_orphan_payment",
    "settlement_id", "gross_amount", "mdr_fee", "gst_on_fee", "net_settled", "settled_date", "is_settled",
    "refund_settlement_id", "refund_amount", "refund_date", "is_refunded",
]


def payments_settled(orders: DataFrame, settled: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """The payments fact from orders and ``settled_gateway`` rows."""
    o = orders.select(
        "order_id", "merchant_id", F.col("status").alias("order_status"),
        F.col("amount").alias("order_amount"), F.lit(True).alias("_known"),
    )
    joined = spread_join(settled, o, "order_id", "left", spread_by="txn_id", hot=hot)
    return joined.withColumns({
        "is_orphan_payment": F.col("_known").isNull(),
        "is_settled": F.col("settlement_id").isNotNull(),
        "is_refunded": F.col("refund_settlement_id").isNotNull(),
    }).select(*PAYMENT_FACT_COLS)


def payments(
    orders: DataFrame, gateway: DataFrame, settlements: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """One row per gateway transaction, duplicate charges kept.

    An orphan here is an event of any status without an order. ``hot`` are the
    heavily repeated order_ids, by default found in ``gateway``.
    """
    hot = hot_keys(gateway, "order_id") if hot is None else hot
    return payments_settled(orders, settled_gateway(gateway, settlements), hot)


def ledger(payments_fact: DataFrame) -> DataFrame:
    """Every transaction with what was charged, settled and returned."""
    return payments_fact.select(
        "txn_id", "order_id", "merchant_id", "event_time", "gateway_status", "gateway_amount",
        "net_settled", "settled_date", "refund_amount", "refund_date",
        "is_settled", "is_refunded", "is_orphan_payment",
    )
