"""Summaries over the facts, and the reads a dashboard makes of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import percent, ratio
from ledgerline.schemas import DETECTORS, MATURITY_DAYS, RECONCILIATION_STATUSES

MONEY_SUM = "decimal(22,2)"


def high_water_mark(run_log: DataFrame) -> DataFrame:
    """One row: the newest day any step has logged."""
    return run_log.agg(F.max("run_date").alias("as_of_date"))


def maturity_cutoff(run_log: DataFrame, buffer_days: int = MATURITY_DAYS) -> DataFrame:
    """One row: midnight before which an order has had time to settle."""
    return high_water_mark(run_log).select(
        F.date_sub("as_of_date", buffer_days).cast("timestamp").alias("cutoff")
    )


def matured(fact: DataFrame, run_log: DataFrame, buffer_days: int = MATURITY_DAYS) -> DataFrame:
    """Fact rows old enough to be held to account."""
    seen = F.coalesce("gateway_event_time", "order_created_at")
    cutoff = F.broadcast(maturity_cutoff(run_log, buffer_days))  # one row
    return fact.crossJoin(cutoff).where(seen <= F.col("cutoff")).drop("cutoff")


def _in_status(status: str) -> Column:
    return F.col("reconciliation_status") == status


def _sum_if(condition: Column, amount: str) -> Column:
    return F.sum(F.when(condition, F.col(amount))).cast(MONEY_SUM)


def daily_summary(fact: DataFrame, run_log: DataFrame) -> DataFrame:
    """Reconciliation health per order date. Orphan payments have no order date and are left out."""
    as_of = F.broadcast(high_water_mark(run_log))  # one row
    rows = (
        fact.where(F.col("order_created_at").isNotNull())
        .withColumn("report_date", F.to_date("order_created_at"))
        .crossJoin(as_of)
        .withColumn("age", F.datediff("as_of_date", "report_date"))
    )
    open_case = _in_status("discrepancy")
    unsettled = (
        F.col("settlement_id").isNull()
        & F.col("order_status").isin("paid", "refunded")
        & (F.col("gateway_status") == "success")
    )
    age = F.when(open_case, F.col("age"))
    return (
        rows.groupBy("report_date")
        .agg(
            F.count("*").alias("total_orders"),
            *[F.count_if(_in_status(s)).alias(f"{s}_count") for s in RECONCILIATION_STATUSES],
            _sum_if(open_case, "order_amount").alias("discrepancy_amount"),
            _sum_if(unsettled, "order_amount").alias("unsettled_amount"),
            F.sum("net_settled").cast(MONEY_SUM).alias("total_net_settled"),
            F.sum(age).alias("age_sum"),
            F.max(age).alias("max_discrepancy_age_days"),
        )
        .withColumns({
            "discrepancy_rate_pct": percent(F.col("discrepancy_count"), F.col("total_orders")),
            "avg_discrepancy_age_days": ratio(F.col("age_sum"), F.col("discrepancy_count"), 1),
        })
        .select(
            "report_date", "total_orders", "matched_count", "discrepancy_count", "refunded_count",
            "pending_count", "discrepancy_rate_pct", "discrepancy_amount", "unsettled_amount",
            "total_net_settled", "avg_discrepancy_age_days", "max_discrepancy_age_days",
        )
    )


# Count column -> the flag it counts.
FLAG_COUNTS = {
    "missing_settlement_count": "is_missing_settlement",
    "late_settlement_count": "is_late_settlement",
    "amount_mismatch_count": "is_amount_mismatch",
    "duplicate_charge_count": "is_duplicate_charge",
    "status_mismatch_count": "is_status_mismatch",
}


def merchant_summary(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Discrepancies per merchant with its current dimension row.

    The fact is grouped before it meets the dimension, so a merchant with most of
    the orders joins as one row. Whether the dimension is broadcast is left to its size.
    """
    open_case = _in_status("discrepancy")
    per_merchant = (
        fact.where(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(
            F.count("*").alias("total_orders"),
            F.count_if(open_case).alias("discrepancy_count"),
            *[F.count_if(F.col(flag)).alias(name) for name, flag in FLAG_COUNTS.items()],
            _sum_if(open_case, "order_amount").alias("discrepancy_amount"),
        )
    )
    current = dim.where("is_current").select("merchant_id", "name", "category", "fee_rate")
    return (
        per_merchant.join(current, "merchant_id")
        .withColumn("discrepancy_rate_pct", percent(F.col("discrepancy_count"), F.col("total_orders")))
        .select(
            "merchant_id", "name", "category", "fee_rate", "total_orders", "discrepancy_count",
            "discrepancy_rate_pct", *FLAG_COUNTS, "discrepancy_amount",
        )
    )


def accuracy(
    fact: DataFrame, answer_key: DataFrame, run_log: DataFrame, buffer_days: int = MATURITY_DAYS
) -> DataFrame:
    """Precision, recall and F1 of each detector against the labelled orders.

    One aggregate over the scored rows holds every detector's counts; it is then
    turned into a row per error type. A flag that is NULL counts nowhere.
    """
    detected = fact.where(~F.col("is_orphan_payment"))
    labels = answer_key.select("order_id", F.col("error_type").alias("expected"))
    scored = matured(detected, run_log, buffer_days).join(labels, "order_id")
    expected = F.col("expected")
    counts, rows = [], []
    for kind, flag in DETECTORS.items():
        raised = F.col(flag)
        cells = {
            "true_positives": raised & (expected == kind),
            "false_positives": raised & (expected != kind),
            "false_negatives": ~raised & (expected == kind),
        }
        counts += [F.count_if(cond).alias(f"{kind}.{name}") for name, cond in cells.items()]
        rows.append(F.struct(
            F.lit(kind).alias("error_type"), *[F.col(f"`{kind}.{name}`").alias(name) for name in cells],
        ))
    per_type = scored.agg(*counts).select(F.inline(F.array(*rows)))
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return per_type.withColumns({
        "precision": ratio(tp, tp + fp, 4),
        "recall": ratio(tp, tp + fn, 4),
        "f1_score": ratio(tp, 2 * tp + fp + fn, 4, scale=2),
    })


def status_trend(daily: DataFrame) -> DataFrame:
    return daily.select("report_date", *[f"{s}_count" for s in RECONCILIATION_STATUSES])


def discrepancy_rate_trend(daily: DataFrame) -> DataFrame:
    return daily.select("report_date", "discrepancy_rate_pct")


def unsettled_trend(daily: DataFrame) -> DataFrame:
    return daily.select("report_date", "unsettled_amount")


def discrepancy_aging(daily: DataFrame) -> DataFrame:
    return daily.select("report_date", "avg_discrepancy_age_days", "max_discrepancy_age_days")


def merchant_leaderboard(summary: DataFrame) -> DataFrame:
    """All merchants, the highest discrepancy rate first; equal rates by merchant_id."""
    return summary.orderBy(F.desc("discrepancy_rate_pct"), "merchant_id")


def merchant_flag_breakdown(summary: DataFrame) -> DataFrame:
    """One row per merchant and discrepancy class, for a stacked chart."""
    wide = summary.select("merchant_id", "name", *FLAG_COUNTS)
    return wide.unpivot(["merchant_id", "name"], list(FLAG_COUNTS), "discrepancy_type", "orders")


def drilldown(
    fact: DataFrame, order_id: str | None = None, merchant_id: str | None = None,
    status: str | None = None, start=None, end=None,
) -> DataFrame:
    """Fact rows for one order, merchant, status or range of order dates."""
    for name, value in (("order_id", order_id), ("merchant_id", merchant_id), ("reconciliation_status", status)):
        if value is not None:
            fact = fact.where(F.col(name) == value)
    # An orphan payment has no order time; it is dated by its payment, as it is in storage.
    # Plain bounds on the columns, so that they reach the scan.
    created, paid = F.col("order_created_at"), F.col("gateway_event_time")
    if start is not None:
        first = F.lit(start).cast("timestamp")
        fact = fact.where((created >= first) | (created.isNull() & (paid >= first)))
    if end is not None:
        after = F.date_add(F.lit(end), 1).cast("timestamp")
        fact = fact.where((created < after) | (created.isNull() & (paid < after)))
    return fact


def headline_metrics(fact: DataFrame, run_log: DataFrame, detectors: DataFrame) -> DataFrame:
    """Totals per status, the share of rejected rows, ingest seconds where the run log has them, and
    mean detector quality, as metric rows."""
    statuses = fact.agg(
        F.count("*").alias("payments_reconciled"),
        *[F.count_if(_in_status(s)).alias(s) for s in RECONCILIATION_STATUSES],
    )
    loads = run_log.where(F.col("step") == "validate").agg(
        F.sum("rows_in").alias("rows_in"), F.sum("rows_rejected").alias("rows_rejected"),
    ).withColumn("rejected_pct", percent(F.col("rows_rejected"), F.col("rows_in")))
    if "duration_seconds" in run_log.columns:
        steps = F.col("step").isin("extract", "validate", "load")
        spent = run_log.where(steps).agg(F.sum("duration_seconds").alias("ingest_seconds"))
        loads = loads.crossJoin(F.broadcast(spent))  # one row each
    quality = detectors.agg(
        F.round(F.avg("precision"), 2).alias("avg_precision"), F.round(F.avg("recall"), 2).alias("avg_recall"),
    )
    names = [*statuses.columns, *loads.columns, *quality.columns]
    # Three frames of one row each.
    wide = statuses.crossJoin(F.broadcast(loads)).crossJoin(F.broadcast(quality))
    as_double = [F.col(n).cast("double").alias(n) for n in names]
    return wide.select(*as_double).unpivot([], names, "metric", "value")
