"""Summaries kept as sums, brought forward by the fact rows that went and came.

Every figure of the summaries is made from counts and exact sums per group, so a change of the fact is a
signed row: minus one for a row that is gone, plus one for a new one. The age of an open case is its day's
distance from the newest load, the same for all cases of a day, so no maximum has to be kept; and
whether an order has had time to settle depends on the day from which on it has, so the detectors'
cells are kept by that day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import percent, ratio
from ledgerline.operators.marts import FLAG_COUNTS, MONEY_SUM, high_water_mark, maturity_cutoff
from ledgerline.schemas import DETECTORS, MATURITY_DAYS, RECONCILIATION_STATUSES

SIGN = "sign"
# Wide enough for sums of signed amounts of any number of rows.
_SUM = "decimal(38,2)"


def signed(gone: DataFrame, come: DataFrame) -> DataFrame:
    """Fact rows with ``sign``, -1 for those that are gone."""
    return gone.withColumn(SIGN, F.lit(-1)).unionByName(come.withColumn(SIGN, F.lit(1)))


def _count(condition: Column, name: str) -> Column:
    return F.sum(F.when(condition, F.col(SIGN)).otherwise(0)).cast("long").alias(name)


def _amount(condition: Column, amount: str, name: str) -> list[Column]:
    """A sum, and how many values are in it: a sum of none is NULL."""
    value = F.when(condition, F.col(amount))
    return [
        F.sum(F.coalesce(value * F.col(SIGN), F.lit(0))).cast(_SUM).alias(name),
        _count(value.isNotNull(), f"{name}_n"),
    ]


def _shown(name: str) -> Column:
    return F.when(F.col(f"{name}_n") > 0, F.col(name)).cast(MONEY_SUM).alias(name)


def _in(status: str) -> Column:
    return F.coalesce(F.col("reconciliation_status") == status, F.lit(False))


def _unsettled() -> Column:
    return F.col("settlement_id").isNull() & F.col("order_status").isin("paid", "refunded") & (F.col("gateway_status") == "success")


def day_sums(rows: DataFrame) -> DataFrame:
    """What ``rows`` add to each order date."""
    return rows.where(F.col("order_created_at").isNotNull()).groupBy(F.to_date("order_created_at").alias("report_date")).agg(
        F.sum(SIGN).cast("long").alias("total_orders"),
        *[_count(_in(s), f"{s}_count") for s in RECONCILIATION_STATUSES],
        *_amount(_in("discrepancy"), "order_amount", "discrepancy_amount"),
        *_amount(F.coalesce(_unsettled(), F.lit(False)), "order_amount", "unsettled_amount"),
        *_amount(F.lit(True), "net_settled", "total_net_settled"),
    )


def merchant_sums(rows: DataFrame) -> DataFrame:
    """What ``rows`` add to each merchant."""
    return rows.where(F.col("merchant_id").isNotNull()).groupBy("merchant_id").agg(
        F.sum(SIGN).cast("long").alias("total_orders"), _count(_in("discrepancy"), "discrepancy_count"),
        *[_count(F.coalesce(F.col(flag), F.lit(False)), name) for name, flag in FLAG_COUNTS.items()],
        *_amount(_in("discrepancy"), "order_amount", "discrepancy_amount"),
    )


def detector_sums(rows: DataFrame, answer_key: DataFrame) -> DataFrame:
    """What ``rows`` add to each detector's cells, by the first day on which an order counts as seen: a
    cutoff is a midnight, so that is its own date if it was seen at midnight, else the next."""
    seen = F.coalesce("gateway_event_time", "order_created_at")
    labels = answer_key.select("order_id", F.col("error_type").alias("expected"))
    scored = rows.where(~F.col("is_orphan_payment") & seen.isNotNull()).join(labels, "order_id")
    day = F.date_add(F.to_date(seen), F.when(seen == F.date_trunc("day", seen), 0).otherwise(1)).alias("seen_by")
    cells = []
    for kind, flag in DETECTORS.items():
        raised, right = F.col(flag), F.col("expected") == kind
        for name, condition in (("tp", raised & right), ("fp", raised & ~right), ("fn", ~raised & right)):
            cells.append(_count(F.coalesce(condition, F.lit(False)), f"{kind}_{name}"))
    return scored.groupBy(day).agg(F.sum(SIGN).cast("long").alias("orders"), *cells)


def add(kept: DataFrame, change: DataFrame, key: str, rows: str) -> DataFrame:
    """Two tables of sums added up; groups that have no rows any more go."""
    values = [c for c in kept.columns if c != key]
    both = kept.unionByName(change)
    total = [F.sum(c).cast(kept.schema[c].dataType).alias(c) for c in values]
    return both.groupBy(key).agg(*total).where(F.col(rows) != 0).select(*kept.columns)


def daily_from(sums: DataFrame, run_log: DataFrame) -> DataFrame:
    """The daily summary out of its sums, as of the newest logged day."""
    as_of = F.broadcast(high_water_mark(run_log))  # one row
    age = F.when(F.col("discrepancy_count") > 0, F.datediff("as_of_date", "report_date"))
    return sums.crossJoin(as_of).select(
        "report_date", "total_orders", "matched_count", "discrepancy_count", "refunded_count", "pending_count",
        percent(F.col("discrepancy_count"), F.col("total_orders")).alias("discrepancy_rate_pct"),
        _shown("discrepancy_amount"), _shown("unsettled_amount"), _shown("total_net_settled"),
        ratio(age * F.col("discrepancy_count"), F.col("discrepancy_count"), 1).alias("avg_discrepancy_age_days"),
        age.alias("max_discrepancy_age_days"),
    )


def merchants_from(sums: DataFrame, dim: DataFrame) -> DataFrame:
    """The merchant summary out of its sums, with the current dimension rows."""
    current = dim.where("is_current").select("merchant_id", "name", "category", "fee_rate")
    return sums.join(current, "merchant_id").select(
        "merchant_id", "name", "category", "fee_rate", "total_orders", "discrepancy_count",
        percent(F.col("discrepancy_count"), F.col("total_orders")).alias("discrepancy_rate_pct"), *FLAG_COUNTS,
        _shown("discrepancy_amount"),
    )


def accuracy_from(sums: DataFrame, run_log: DataFrame, buffer_days: int = MATURITY_DAYS) -> DataFrame:
    """Precision, recall and F1 of each detector out of its cells, over the orders that have had time to settle."""
    cutoff = F.broadcast(maturity_cutoff(run_log, buffer_days))  # one row
    mature = sums.crossJoin(cutoff).where(F.col("seen_by").cast("timestamp") <= F.col("cutoff"))
    zero = F.lit(0).cast("long")
    totals = mature.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in sums.columns if c not in ("seen_by", "orders")])
    rows = [
        F.struct(F.lit(kind).alias("error_type"), *[F.col(f"{kind}_{short}").alias(name) for short, name in (
            ("tp", "true_positives"), ("fp", "false_positives"), ("fn", "false_negatives"))])
        for kind in DETECTORS
    ]
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return totals.select(F.inline(F.array(*rows))).withColumns({
        "precision": ratio(tp, tp + fp, 4), "recall": ratio(tp, tp + fn, 4),
        "f1_score": ratio(tp, 2 * tp + fp + fn, 4, scale=2),
    })


