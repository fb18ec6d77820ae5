"""Data-quality checks: each is a query for the rows that fail it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.money import percent
from ledgerline.operators.dimensions import settlement_fees
from ledgerline.operators.marts import matured
from ledgerline.operators.skew import hot_keys, spread_join
from ledgerline.schemas import (
    EXPECTED_RESULTS, GATEWAY_STATUSES, ORDER_STATUSES, RECONCILIATION_STATUSES, SETTLEMENT_TYPES,
)

# The declared checks per table.
NOT_NULL = {
    "raw_orders": ["order_id"],
    "raw_gateway": ["txn_id"],
    "raw_settlements": ["settlement_id"],
    "stg_orders": ["order_id", "merchant_id", "amount"],
    "stg_gateway_events": ["txn_id"],
    "stg_settlements": ["settlement_id", "txn_id"],
    "dim_date": ["date_day"],
    "dim_merchants": ["merchant_id", "dbt_valid_from"],
    "fact_reconciliation": ["order_id"],
    "fact_payments": ["txn_id"],
    "daily_reconciliation_summary": ["report_date"],
    "merchant_discrepancy_summary": ["merchant_id"],
    "accuracy_by_error_type": ["error_type"],
    "answer_key": ["order_id"],
}
UNIQUE = {
    "stg_orders": "order_id",
    "stg_gateway_events": "txn_id",
    "stg_settlements": "settlement_id",
    "dim_date": "date_day",
    "fact_reconciliation": "order_id",
    "fact_payments": "txn_id",
    "daily_reconciliation_summary": "report_date",
    "merchant_discrepancy_summary": "merchant_id",
    "accuracy_by_error_type": "error_type",
}
ACCEPTED_VALUES = {
    "stg_orders": ("status", ORDER_STATUSES),
    "stg_gateway_events": ("gateway_status", GATEWAY_STATUSES),
    "stg_settlements": ("settlement_type", SETTLEMENT_TYPES),
    "fact_reconciliation": ("reconciliation_status", RECONCILIATION_STATUSES),
    "fact_payments": ("gateway_status", GATEWAY_STATUSES),
    "answer_key": ("expected_result", EXPECTED_RESULTS),
}


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once, with how often."""
    return (
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def accepted_values(df: DataFrame, col: str, values: tuple[str, ...]) -> DataFrame:
    """Values outside the accepted set, with how often; NULL is not judged."""
    return df.where(~F.col(col).isin(*values)).groupBy(col).agg(F.count("*").alias("n_records"))


def relationships(
    child: DataFrame, col: str, parent: DataFrame, parent_col: str, where: Column | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Child rows whose key has no parent.

    The parent keys need not be unique. A key that holds many of the child rows is spread.
    """
    child = child if where is None else child.where(where)
    keys = parent.select(F.col(parent_col).alias(col)).distinct()
    return spread_join(child.where(F.col(col).isNotNull()), keys, col, "left_anti", hot=hot)


def answer_key_disagreements(fact: DataFrame, answer_key: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Orders whose status is not the labelled one. Pass ``matured`` rows to allow for late data.

    Labels are unique by order. An order id that no order has may hold many payments; their rows are spread.
    """
    label = F.col("expected_result")
    expected = answer_key.select(
        "order_id", F.when(label == "match", "matched").otherwise(label).alias("expected_status")
    )
    actual = fact.where(F.col("order_id").isNotNull()).select(
        "order_id", F.col("reconciliation_status").alias("actual_status"), "txn_id"
    )
    return (
        spread_join(actual, expected, "order_id", "inner", spread_by="txn_id", hot=hot)
        .where(F.col("actual_status") != F.col("expected_status"))
        .select("order_id", "actual_status", "expected_status")
    )


def negative_amounts(orders: DataFrame, gateway: DataFrame) -> DataFrame:
    """Orders and gateway events with an amount below zero."""

    def below_zero(df: DataFrame, source: str, key: str) -> DataFrame:
        return df.where(F.col("amount") < 0).select(
            F.lit(source).alias("source"), F.col(key).alias("id"), "amount"
        )

    return below_zero(orders, "order", "order_id").unionByName(below_zero(gateway, "gateway", "txn_id"))


def volume_anomalies(daily: DataFrame, limit: float = 0.5) -> DataFrame:
    """Days whose order count moved by more than ``limit`` against the day before.

    The window has no partition: its input is one row per day, not per order.
    """
    previous = F.lag("total_orders").over(Window.orderBy("report_date"))
    change = F.col("total_orders") - F.col("prior_day_orders")
    return (
        daily.select("report_date", "total_orders")
        .withColumn("prior_day_orders", previous)
        .where(F.col("prior_day_orders").isNotNull() & (F.abs(change) > F.col("prior_day_orders") * limit))
        .withColumn("pct_change", percent(change, F.col("prior_day_orders"), 1))
    )


def orphan_settlements(
    settlements: DataFrame, gateway: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Settlements whose transaction never appeared at the gateway; a missing txn_id counts."""
    no_txn = settlements.where(F.col("txn_id").isNull())
    lost = relationships(settlements, "txn_id", gateway, "txn_id", hot=hot)
    return lost.select("settlement_id", "txn_id").unionByName(no_txn.select("settlement_id", "txn_id"))


def fee_disagreements(
    settlements: DataFrame, payments_fact: DataFrame, order_fees: DataFrame,
    hot_txns: DataFrame | None = None, hot_orders: DataFrame | None = None,
) -> DataFrame:
    """Payment settlements whose stored fees differ from the rate valid at the order.

    ``order_fees`` has order_id and fee_rate (see ``fee_as_of``). Orders with two
    settled transactions are checked once per transaction.
    """
    lines = settlements.where(F.col("settlement_type") == "payment")
    owners = payments_fact.where(~F.col("is_orphan_payment")).select("txn_id", "order_id")
    owned = spread_join(lines, owners, "txn_id", "inner", spread_by="settlement_id", hot=hot_txns)
    hot_orders = hot_keys(payments_fact, "order_id") if hot_orders is None else hot_orders
    rated = spread_join(
        owned, order_fees.select("order_id", "fee_rate"), "order_id", "inner", spread_by="settlement_id",
        hot=hot_orders,
    )
    c = F.col
    return settlement_fees(rated, "fee_rate").where(
        (c("mdr_fee") != c("expected_mdr_fee"))
        | (c("gst_on_fee") != c("expected_gst_on_fee"))
        | (c("net_settled") != c("expected_net_settled"))
    ).select(
        "settlement_id", "txn_id", "order_id", "gross_amount", "fee_rate",
        "mdr_fee", "expected_mdr_fee", "gst_on_fee", "expected_gst_on_fee",
        "net_settled", "expected_net_settled",
    )


@dataclass(frozen=True)
class Check:
    """A named query for failing rows; ``error`` stops a run, ``warn`` is only reported."""

    name: str
    failing: DataFrame
    severity: str = "error"


@dataclass(frozen=True)
class RowRule:
    """A rule judged row by row; ``broken`` is true where a row fails it."""

    kind: str
    column: str
    broken: Column


def not_null_rules(declared: dict[str, list[str]] = NOT_NULL) -> dict[str, list[RowRule]]:
    return {t: [RowRule("not_null", c, F.col(c).isNull()) for c in cols] for t, cols in declared.items()}


def accepted_value_rules(
    declared: dict[str, tuple[str, tuple[str, ...]]] = ACCEPTED_VALUES
) -> dict[str, list[RowRule]]:
    return {t: [RowRule("accepted_values", c, ~F.col(c).isin(*values))] for t, (c, values) in declared.items()}


def row_rule_counts(tables: dict[str, DataFrame], rules: dict[str, list[RowRule]]) -> DataFrame:
    """(kind, table_name, column_name, failures): one pass over each table for all of its rules."""
    parts = []
    for table, table_rules in rules.items():
        names = [f"{r.kind}.{r.column}" for r in table_rules]
        counted = tables[table].agg(*[F.count_if(r.broken).alias(n) for r, n in zip(table_rules, names)])
        cells = [
            F.struct(
                F.lit(r.kind).alias("kind"), F.lit(table).alias("table_name"),
                F.lit(r.column).alias("column_name"), F.col(f"`{n}`").alias("failures"),
            )
            for r, n in zip(table_rules, names)
        ]
        parts.append(counted.select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


def not_null_counts(tables: dict[str, DataFrame], declared: dict[str, list[str]] = NOT_NULL) -> DataFrame:
    return row_rule_counts(tables, not_null_rules(declared)).drop("kind")


def accepted_value_counts(
    tables: dict[str, DataFrame], declared: dict[str, tuple[str, tuple[str, ...]]] = ACCEPTED_VALUES
) -> DataFrame:
    return row_rule_counts(tables, accepted_value_rules(declared)).drop("kind")


def unique_counts(tables: dict[str, DataFrame], declared: dict[str, str] = UNIQUE) -> DataFrame:
    parts = [
        unique(tables[t], c).agg(F.count("*").alias("failures")).select(
            F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "failures"
        )
        for t, c in declared.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def singular_checks(tables: dict[str, DataFrame]) -> list[Check]:
    """The checks that span tables."""
    fact = tables["fact_reconciliation"]
    return [
        Check("relationships.fact_reconciliation.merchant_id", relationships(
            fact, "merchant_id", tables["dim_merchants"], "merchant_id", F.col("merchant_id").isNotNull(),
        )),
        Check("reconciliation_matches_answer_key", answer_key_disagreements(
            matured(fact, tables["run_log"]), tables["answer_key"],
        )),
        Check("no_negative_payment_amounts", negative_amounts(tables["stg_orders"], tables["stg_gateway_events"])),
        Check("no_daily_row_count_anomaly", volume_anomalies(tables["daily_reconciliation_summary"]), "warn"),
        Check(
            "no_orphan_settlements",
            orphan_settlements(tables["stg_settlements"], tables["stg_gateway_events"]), "warn",
        ),
    ]


def count_failures(checks: list[Check]) -> DataFrame:
    """(check_name, severity, failures), one row per check."""
    parts = [
        c.failing.agg(F.count("*").alias("failures")).select(
            F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "failures"
        )
        for c in checks
    ]
    return reduce(DataFrame.unionByName, parts)


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared and cross-table check. ``tables`` should be stored tables: each is read repeatedly."""
    rules = not_null_rules()
    for table, extra in accepted_value_rules().items():
        rules[table] = [*rules.get(table, []), *extra]
    declared = row_rule_counts(tables, rules).unionByName(
        unique_counts(tables).withColumn("kind", F.lit("unique"))
    )
    named = declared.select(
        F.concat_ws(".", "kind", "table_name", "column_name").alias("check_name"),
        F.lit("error").alias("severity"), "failures",
    )
    return named.unionByName(count_failures(singular_checks(tables)))


class QualityError(RuntimeError):
    """At least one check of severity ``error`` has failing rows."""


def raise_on_errors(report: DataFrame) -> None:
    """Stop the run if an error-severity check failed; the report has one row per check."""
    failed = report.where((F.col("severity") == "error") & (F.col("failures") > 0)).collect()
    if failed:
        raise QualityError(", ".join(f"{r.check_name}: {r.failures}" for r in failed))
