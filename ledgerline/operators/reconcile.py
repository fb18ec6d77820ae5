"""Order-grain reconciliation of orders, gateway events and settlements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.skew import hot_keys, nulls_last, spread_join
from ledgerline.session import materialize

PAYMENT_COLS = ["settlement_id", "gross_amount", "mdr_fee", "gst_on_fee", "net_settled", "settled_date"]
REFUND_COLS = {
    "refund_settlement_id": "settlement_id", "refund_amount": "net_settled", "refund_date": "settled_date",
}
JOINED_COLS = [
    "order_id", "merchant_id", "order_amount", "order_status", "order_created_at",
    "txn_id", "gateway_status", "gateway_amount", "gateway_event_time", "event_count",
    "settlement_id", "gross_amount", "net_settled", "settled_date",
    "refund_settlement_id", "refund_amount", "refund_date", "is_orphan_payment",
]
FLAGS = [
    "is_duplicate_charge", "is_status_mismatch", "is_missing_settlement",
    "is_amount_mismatch", "is_late_settlement", "is_refunded",
]
FACT_COLS = [*JOINED_COLS, *FLAGS, "reconciliation_status"]


def _earliest(fields: Column, kind: str) -> Column:
    """The row of one settlement type with the earliest date; NULL dates last."""
    rank = F.struct(*nulls_last("settled_date"), "settlement_id")
    return F.min_by(fields, F.when(F.col("settlement_type") == kind, rank))


def settlements_per_txn(settlements: DataFrame) -> DataFrame:
    """First payment and first refund per transaction, in one grouped pass."""
    payment = F.struct(*PAYMENT_COLS)
    refund = F.struct(*[F.col(src).alias(name) for name, src in REFUND_COLS.items()])
    return (
        settlements.where(F.col("txn_id").isNotNull())
        .groupBy("txn_id")
        .agg(_earliest(payment, "payment").alias("p"), _earliest(refund, "refund").alias("r"))
        .select("txn_id", "p.*", "r.*")
    )


def settlement_by_txn(settlements: DataFrame, kind: str) -> DataFrame:
    """First settlement of one type per transaction."""
    return (
        settlements.where((F.col("settlement_type") == kind) & F.col("txn_id").isNotNull())
        .groupBy("txn_id")
        .agg(_earliest(F.struct(*PAYMENT_COLS), kind).alias("s"))
        .select("txn_id", "s.*")
    )


def settled_gateway(gateway: DataFrame, settlements: DataFrame) -> DataFrame:
    """Gateway events with their settlement and refund; both sides unique on txn_id.

    Settlements meet the events here rather than after the events have been joined
    to orders: there every order without an event carries a NULL txn_id, and all of
    those rows would land in one task.
    """
    events = gateway.select(
        "txn_id", "order_id", "gateway_status", F.col("amount").alias("gateway_amount"),
        "event_time", "event_type",
    )
    return events.join(settlements_per_txn(settlements), "txn_id", "left")


def _primary_rank() -> Column:
    """Earliest success first, else earliest event; an unknown status sorts ahead of both."""
    status = F.col("gateway_status")
    rank = F.when(status.isNull(), 0).when(status == "success", 1).otherwise(2)
    return F.struct(rank, *nulls_last("event_time"), "txn_id")


def gateway_by_order(events: DataFrame) -> DataFrame:
    """Event count and primary event per order.

    Accepts gateway events, or ``settled_gateway`` rows, whose settlement columns
    are carried along. Both results come from one grouping with map-side partial
    aggregation, so a heavily repeated order_id reaches the reducer as one row per task.
    """
    if "gateway_amount" not in events.columns:
        events = events.withColumnRenamed("amount", "gateway_amount")
    carried = [c for c in [*PAYMENT_COLS, *REFUND_COLS] if c in events.columns]
    picked = F.struct("txn_id", "gateway_status", "gateway_amount", "event_time", *carried)
    return (
        events.groupBy("order_id")
        .agg(
            F.count("*").alias("event_count"),
            F.count_if(F.col("gateway_status") == "success").alias("success_event_count"),
            F.min_by(picked, _primary_rank()).alias("e"),
        )
        .select("order_id", "event_count", "success_event_count", "e.*")
    )


def orphan_payments(settled: DataFrame, orders: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Successful events whose order does not exist, one row per transaction.

    An anti join on non-null keys: a literal NOT IN would have to broadcast the
    order ids. Refunds are not looked up for orphans. ``hot`` are the heavily
    repeated order_ids, by default found in ``settled``.
    """
    lost = settled.where((F.col("gateway_status") == "success") & F.col("order_id").isNotNull())
    lost = spread_join(
        lost, orders.select("order_id"), "order_id", "left_anti", spread_by="txn_id", hot=hot,
    )
    return _orphan_columns(lost)


def _orphan_columns(lost: DataFrame) -> DataFrame:
    return lost.select(
        "order_id", "txn_id", "gateway_status", "gateway_amount",
        F.col("event_time").alias("gateway_event_time"), F.lit(1).cast("long").alias("event_count"),
        "settlement_id", "gross_amount", "net_settled", "settled_date",
        F.lit(True).alias("is_orphan_payment"),
    )


def matched_rows(orders: DataFrame, settled: DataFrame) -> DataFrame:
    """Every order with its primary event and that event's settlement and refund."""
    per_order = gateway_by_order(settled.where(F.col("order_id").isNotNull()))
    o = orders.select(
        "order_id", "merchant_id", F.col("amount").alias("order_amount"),
        F.col("status").alias("order_status"), F.col("created_at").alias("order_created_at"),
    )
    return (
        o.join(per_order.withColumnRenamed("event_time", "gateway_event_time"), "order_id", "left")
        .withColumns({
            "event_count": F.coalesce("event_count", F.lit(0)),
            "is_orphan_payment": F.lit(False),
        })
        .select(*JOINED_COLS)
    )


def flag_discrepancies(joined: DataFrame) -> DataFrame:
    """Add the discrepancy flags. NULL stays NULL: unknown is not the same as no."""
    c = F.col
    charged = c("order_status").isin("paid", "refunded")
    succeeded = c("gateway_status") == "success"
    declined = c("gateway_status") == "failed"
    settled = c("settlement_id").isNotNull()
    due = F.date_add(F.to_date("gateway_event_time"), 1)
    return joined.withColumns({
        "is_duplicate_charge": c("event_count") > 1,
        "is_status_mismatch": (charged & (c("gateway_status").isNull() | declined))
        | ((c("order_status") == "failed") & succeeded),
        "is_missing_settlement": charged & succeeded & ~settled,
        "is_amount_mismatch": settled & c("order_amount").isNotNull()
        & (c("gross_amount") != c("order_amount")),
        "is_late_settlement": settled & c("settled_date").isNotNull()
        & c("gateway_event_time").isNotNull() & (c("settled_date") > due),
        "is_refunded": c("refund_settlement_id").isNotNull(),
    })


def with_status(flagged: DataFrame) -> DataFrame:
    """Roll the flags into one reconciliation_status; the first rule that holds wins."""
    c = F.col
    order, gateway = c("order_status"), c("gateway_status")
    settled = c("settlement_id").isNotNull()
    wrong = (
        c("is_duplicate_charge") | c("is_status_mismatch") | c("is_missing_settlement")
        | c("is_amount_mismatch") | c("is_late_settlement")
    )
    status = (
        F.when(order == "created", "pending")
        .when(c("is_orphan_payment"), "discrepancy")
        .when(wrong, "discrepancy")
        .when((order == "refunded") & (gateway == "success") & settled & c("is_refunded"), "refunded")
        .when((order == "paid") & (gateway == "success") & settled, "matched")
        .when((order == "failed") & (gateway == "failed"), "matched")
        .otherwise("discrepancy")
    )
    return flagged.withColumn("reconciliation_status", status)


def _fact(matched: DataFrame, orphans: DataFrame) -> DataFrame:
    joined = matched.unionByName(orphans, allowMissingColumns=True)
    return with_status(flag_discrepancies(joined)).select(*FACT_COLS)


def reconcile_settled(orders: DataFrame, settled: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """The reconciliation fact from orders and ``settled_gateway`` rows."""
    return _fact(matched_rows(orders, settled), orphan_payments(settled, orders, hot))


def reconcile_payments(orders: DataFrame, payments_fact: DataFrame) -> DataFrame:
    """The reconciliation fact from orders and a stored payments fact.

    The payments fact already knows which events have no order, so the orphans are a
    filter on it and the join that finds them is not repeated.
    """
    lost = payments_fact.where(
        F.col("is_orphan_payment") & (F.col("gateway_status") == "success") & F.col("order_id").isNotNull()
    )
    return _fact(matched_rows(orders, payments_fact.drop("is_orphan_payment")), _orphan_columns(lost))


def reconcile(
    orders: DataFrame, gateway: DataFrame, settlements: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """One row per order plus one per orphan payment, with flags and status."""
    hot = hot_keys(gateway, "order_id") if hot is None else hot
    return reconcile_settled(orders, settled_gateway(gateway, settlements), hot)


def affected_orders(orders: DataFrame, gateway: DataFrame, settlements: DataFrame, run_date) -> DataFrame:
    """Orders with an order, gateway or settlement row loaded on ``run_date``."""
    today = F.col("run_date") == F.lit(run_date)
    settled_txns = settlements.where(today & F.col("txn_id").isNotNull()).select("txn_id").distinct()
    keys = (
        orders.where(today).select("order_id")
        .union(gateway.where(today).select("order_id"))
        .union(gateway.join(settled_txns, "txn_id", "left_semi").select("order_id"))
    )
    return keys.where(F.col("order_id").isNotNull()).distinct()


def reconcile_keys(
    orders: DataFrame, gateway: DataFrame, settlements: DataFrame, keys: DataFrame,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Reconcile only the given order_ids.

    Orders and events are cut down first, and settlements to the transactions that are left,
    so nothing of the history is grouped. The events are read several times and so are
    written to the work folder.
    """
    hot = hot_keys(gateway, "order_id") if hot is None else hot
    events = materialize(
        spread_join(gateway, keys, "order_id", "left_semi", spread_by="txn_id", hot=hot), "events"
    )
    lines = settlements.join(events.select("txn_id"), "txn_id", "left_semi")
    return reconcile(orders.join(keys, "order_id", "left_semi"), events, lines, hot)
