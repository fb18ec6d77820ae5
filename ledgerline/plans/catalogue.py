"""Every operator as a named query over a folder of input tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import parse_money
from ledgerline.operators import contract as rules
from ledgerline.operators import deltas, dimensions, marts, merge, payments, quality, reconcile, staging
from ledgerline.operators.skew import hot_keys
from ledgerline.plans import fixtures, forward
from ledgerline.schemas import CONTRACTS
from ledgerline.session import built_once, materialize, prepare, stored_once, temporary_folder, together
from ledgerline.sources.csv_files import read_drop
from ledgerline.sources.extract import orders_incremental_pull
from ledgerline.sources.tables import Tables

LAST = fixtures.day(fixtures.LAST_DAY)


def publish(df: DataFrame) -> DataFrame:
    """Result types every engine shows alike: DOUBLE for decimals, ISO text for dates,
    timestamps without a zone. The operators themselves keep decimals and dates."""
    shown = []
    for name, kind in df.dtypes:
        if kind.startswith("decimal"):
            shown.append(F.col(name).cast("double").alias(name))
        elif kind == "date":
            shown.append(F.col(name).cast("string").alias(name))
        elif kind == "timestamp":
            shown.append(F.col(name).cast("timestamp_ntz").alias(name))
        else:
            shown.append(F.col(name))
    return df.select(*shown)


class Inputs:
    """The tables one query needs, derived on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.folder_id = hashlib.md5(sf_dir.encode()).hexdigest()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stored(self, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A table derived from the orders, written once per application and input folder.

        These stand for the tables that the three systems would deliver; queries start
        from the stored copy.
        """
        label = f"inputs/{self.folder_id}/{build.__name__}"
        return stored_once(self.spark, label, lambda: build(fixtures.base(self.spark, self.sf_dir)))

    @cached_property
    def raw_orders(self) -> DataFrame:
        return self.stored(fixtures.raw_orders)

    @cached_property
    def raw_gateway(self) -> DataFrame:
        return self.stored(fixtures.raw_gateway)

    @cached_property
    def raw_settlements(self) -> DataFrame:
        return self.stored(fixtures.raw_settlements)

    @cached_property
    def merchant_history(self) -> DataFrame:
        return stored_once(
            self.spark, f"inputs/{self.folder_id}/merchant_history",
            lambda: fixtures.merchant_history(self.spark, self.sf_dir),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders(self.raw_orders)

    @cached_property
    def gateway(self) -> DataFrame:
        return staging.stg_gateway_events(self.raw_gateway)

    @cached_property
    def settlements(self) -> DataFrame:
        return staging.stg_settlements(self.raw_settlements)

    @cached_property
    def redelivered(self) -> DataFrame:
        """Staged settlements out of loads that repeat and lack things."""
        return staging.stg_settlements(fixtures.redelivered_settlements(self.raw_settlements))

    @cached_property
    def hot_orders(self) -> DataFrame:
        # Looked for in the loads, ahead of the dedupe: one column and no shuffle.
        return hot_keys(self.raw_gateway, "order_id")

    @cached_property
    def hot_merchants(self) -> DataFrame:
        return hot_keys(self.raw_orders, "merchant_id")

    @cached_property
    def hot_txns(self) -> DataFrame:
        return hot_keys(self.raw_settlements, "txn_id")

    @cached_property
    def settled(self) -> DataFrame:
        return reconcile.settled_gateway(self.gateway, self.settlements)

    @cached_property
    def fact(self) -> DataFrame:
        # Orders and orphans both start from the settled events, which are computed once.
        settled = materialize(self.settled, "settled")
        return reconcile.reconcile_settled(self.orders, settled, self.hot_orders)

    @cached_property
    def payments(self) -> DataFrame:
        return payments.payments_settled(self.orders, self.settled, self.hot_orders)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark)

    @cached_property
    def run_log(self) -> DataFrame:
        return fixtures.load_days(self.spark)

    @cached_property
    def daily(self) -> DataFrame:
        return marts.daily_summary(self.fact, self.run_log)

    @cached_property
    def snapshot(self) -> DataFrame:
        return dimensions.chain_versions(self.merchant_history, "merchant_id", "updated_at")

    @cached_property
    def dim_merchants(self) -> DataFrame:
        return dimensions.dim_merchants(self.snapshot)

    @cached_property
    def merchant_summary(self) -> DataFrame:
        return marts.merchant_summary(self.fact, self.dim_merchants)

    @cached_property
    def answer_key(self) -> DataFrame:
        return fixtures.answer_key(self.stored(fixtures.truth))

    @cached_property
    def accuracy(self) -> DataFrame:
        return marts.accuracy(self.fact, self.answer_key, self.run_log)

    def checked(self, source: str) -> DataFrame:
        staged = {
            "orders": fixtures.staged_orders,
            "gateway": fixtures.staged_gateway,
            "settlement": fixtures.staged_settlements,
        }
        return rules.with_reason(self.stored(staged[source]), CONTRACTS[source])

    def all_checked(self) -> dict[str, DataFrame]:
        return {source: self.checked(source) for source in CONTRACTS}

    def store(self, **frames: DataFrame) -> None:
        """Write frames at the same time and continue from the stored copies."""
        written = together(*[partial(materialize, df, name) for name, df in frames.items()])
        for name, df in zip(frames, written):
            setattr(self, name, df)

    def store_staging(self) -> None:
        self.store(orders=self.orders, gateway=self.gateway, settlements=self.settlements)

    def scratch(self, label: str) -> Tables:
        """Tables of this query's own, below the temporary copies."""
        return Tables(self.spark, temporary_folder(self.spark, label))

    def tables(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """The named tables. What several of them are made from is written first, as the daily
        job does, and nothing else is."""
        found = set(names)
        for name in reversed(_TABLES):
            if name in found:
                found.update(_TABLES[name].made_from)
        for stage in sorted({_TABLES[name].stage for name in found} - {0}):
            self.store(**{
                t.attribute: getattr(self, t.attribute) for name, t in _TABLES.items() if name in found and t.stage == stage
            })
            if stage == 2 and "fact_reconciliation" in found:
                self.fact = reconcile.reconcile_payments(self.orders, self.payments)
        return {name: getattr(self, _TABLES[name].attribute) for name in names}


@dataclass(frozen=True)
class Derived:
    """A table by the attribute of Inputs that makes it, when it is stored (0: as it is), and what it is made from."""

    attribute: str
    stage: int = 0
    made_from: tuple[str, ...] = ()


_STAGED = ("stg_orders", "stg_gateway_events", "stg_settlements")
_TABLES = {
    "raw_orders": Derived("raw_orders"),
    "raw_gateway": Derived("raw_gateway"),
    "raw_settlements": Derived("raw_settlements"),
    "run_log": Derived("run_log"),
    "dim_date": Derived("dim_date"),
    "stg_orders": Derived("orders", 1),
    "stg_gateway_events": Derived("gateway", 1),
    "stg_settlements": Derived("settlements", 1),
    "dim_merchants": Derived("dim_merchants", 2),
    "answer_key": Derived("answer_key", 2),
    "fact_payments": Derived("payments", 2, _STAGED),
    "fact_reconciliation": Derived("fact", 3, ("fact_payments", "stg_orders")),
    "daily_reconciliation_summary": Derived("daily", 4, ("fact_reconciliation",)),
    "merchant_discrepancy_summary": Derived("merchant_summary", 4, ("fact_reconciliation", "dim_merchants")),
    "accuracy_by_error_type": Derived("accuracy", 4, ("fact_reconciliation", "answer_key")),
}


def _dead_letters(i: Inputs) -> DataFrame:
    first, *rest = [rules.rejects(rows, CONTRACTS[name]) for name, rows in i.all_checked().items()]
    for frame in rest:
        first = first.unionByName(frame)
    return first


def _kept(i: Inputs) -> Tables:
    """The kept tables as of the day before the last, and the last day's loads brought forward by the
    daily job's own step; once per application and input folder."""

    def build(root: str) -> None:
        tables = Tables(i.spark, root)
        loads = {forward.RAW["orders"]: i.raw_orders, forward.RAW["gateway"]: i.raw_gateway, forward.RAW["settlement"]: i.raw_settlements}
        before = F.col("run_date") < F.lit(LAST)
        with tables.commit():
            together(
                lambda: tables.overwrite(forward.ANSWER_KEY, i.answer_key),
                *[partial(tables.load_days, name, df.where(before)) for name, df in loads.items()],
            )
            forward.rebuild(tables)
        with tables.commit():
            together(*[partial(tables.replace_day, name, df.where(~before), LAST) for name, df in loads.items()])
            forward.advance(tables, LAST)

    return Tables(i.spark, built_once(i.spark, f"inputs/{i.folder_id}/kept", build))


def _kept_staging(i: Inputs, source: str) -> DataFrame:
    return forward.staged(_kept(i))[source]


def _scd2(i: Inputs) -> DataFrame:
    """History up to the last day, merged with the merchants as they stand on it."""
    history = i.merchant_history
    last_day = F.col("updated_at") >= F.lit(LAST).cast("timestamp")
    snapshot = dimensions.chain_versions(history.where(~last_day), "merchant_id", "updated_at")
    now = staging.latest_by(history, "merchant_id", ["updated_at"])
    return dimensions.scd2_merge(snapshot, now, "merchant_id", "updated_at")


def _order_days(i: Inputs) -> DataFrame:
    """The calendar with the number of orders placed on each day."""
    per_day = i.orders.groupBy(F.to_date("created_at").alias("date_day")).agg(F.count("*").alias("orders"))
    return (
        dimensions.dim_date(i.spark).join(per_day, "date_day", "left")
        .withColumn("orders", F.coalesce("orders", F.lit(0)))
    )


def _not_null(i: Inputs) -> DataFrame:
    optional = {"fact_reconciliation": ["order_id", "merchant_id", "txn_id", "settlement_id"]}
    declared = quality.NOT_NULL | optional
    return quality.not_null_counts(i.tables(declared), declared)


def _unique(i: Inputs) -> DataFrame:
    declared = quality.UNIQUE | {"raw_orders": "order_id", "raw_gateway": "txn_id"}
    return quality.unique_counts(i.tables(declared), declared)


def _accepted(i: Inputs) -> DataFrame:
    tables = i.tables(quality.ACCEPTED_VALUES) | {"staged_orders": i.checked("orders"), "staged_settlements": i.checked("settlement")}
    raw = {
        "staged_orders": quality.ACCEPTED_VALUES["stg_orders"],
        "staged_settlements": quality.ACCEPTED_VALUES["stg_settlements"],
    }
    return quality.accepted_value_counts(tables, quality.ACCEPTED_VALUES | raw)


def _relationships(i: Inputs) -> DataFrame:
    merchants = quality.relationships(
        i.fact, "merchant_id", i.dim_merchants, "merchant_id", F.col("merchant_id").isNotNull(),
        hot=i.hot_merchants,
    ).select(F.lit("fact_reconciliation.merchant_id").alias("relation"), F.col("merchant_id").alias("value"))
    orders = quality.relationships(i.gateway, "order_id", i.orders, "order_id", hot=i.hot_orders).select(
        F.lit("stg_gateway_events.order_id").alias("relation"), F.col("order_id").alias("value")
    )
    return merchants.unionByName(orders)


def _negative(i: Inputs) -> DataFrame:
    def amounts(name: str) -> DataFrame:
        return i.checked(name).withColumn("amount", parse_money(F.col("amount")))

    return quality.negative_amounts(amounts("orders"), amounts("gateway"))


def _volume(i: Inputs) -> DataFrame:
    per_day = i.table("orders").groupBy(F.to_date("o_orderdate").alias("report_date"))
    return quality.volume_anomalies(per_day.agg(F.count("*").alias("total_orders")))


def _day_replace(i: Inputs) -> DataFrame:
    """Bronze gateway rows with one day loaded again from its judged rows."""
    tables = i.scratch("day-replace")
    name, day = "raw/gateway_events", fixtures.day(4)
    tables.load_days(name, i.raw_gateway)
    redone = i.checked("gateway").where(F.col("run_date") == F.lit(day))
    loaded = rules.typed(rules.valid(redone), CONTRACTS["gateway"])
    stamped = loaded.withColumn("ingested_at", F.lit(fixtures.day(20)).cast("timestamp"))
    tables.replace_day(name, stamped, day)
    return tables.read(name)


def _upsert(i: Inputs) -> DataFrame:
    """The application's orders after the status changes of the later loads."""
    columns = CONTRACTS["orders"].required
    resolved = F.col("updated_at") > F.col("created_at")
    first = i.raw_orders.where(~resolved).select(*columns)
    return merge.upsert(first, i.raw_orders.where(resolved).select(*columns), "order_id", ["status", "updated_at"])


def _fee_check(i: Inputs) -> DataFrame:
    fees = dimensions.fee_as_of(i.orders, i.snapshot, i.hot_merchants)
    return quality.fee_disagreements(i.settlements, i.payments, fees, i.hot_txns, i.hot_orders)


def _misled(answer_key: DataFrame) -> DataFrame:
    """The labels with every seventh one wrong, for a check that has to find something."""
    wrong = F.substring("order_id", 5, 20).cast("long") % 7 == 3
    return answer_key.withColumn("expected_result", F.when(wrong, "pending").otherwise(F.col("expected_result")))


def _validated(name: str) -> Callable[[Inputs], DataFrame]:
    return lambda i: i.checked(name)


def _gateway_drop(i: Inputs) -> DataFrame:
    """The gateway's deliveries as CSV files, read by the drop reader and judged by the contract.
    A CSV file has one kind of empty cell, which is read as NULL."""
    delivered = i.stored(fixtures.staged_gateway)
    folder = temporary_folder(i.spark, "gateway-drop")
    delivered.withColumn("run_date", F.col("run_date").cast("string")).write.csv(folder, header=True, escape='"')
    rows = read_drop(i.spark, folder, CONTRACTS["gateway"]).withColumn("run_date", F.col("run_date").cast("date"))
    return rules.with_reason(rows, CONTRACTS["gateway"]).select(*i.checked("gateway").columns)


def _headline(i: Inputs) -> DataFrame:
    i.store(fact=i.fact)
    return marts.headline_metrics(i.fact, rules.run_log_by_day(list(i.all_checked().values())), i.accuracy)


_BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {
    "orders_incremental_pull": lambda i: orders_incremental_pull(
        i.stored(fixtures.app_orders), fixtures.day(5)
    ).orderBy("order_id"),
    "validate_orders": _validated("orders"),
    "validate_gateway": _validated("gateway"),
    "validate_settlements": _validated("settlement"),
    "ingest_gateway_csv": _gateway_drop,
    "rejects_dead_letter": _dead_letters,
    "rejects_by_reason": lambda i: rules.by_reason(_dead_letters(i)),
    "stg_orders": lambda i: i.orders,
    "stg_gateway_events": lambda i: i.gateway,
    "stg_settlements": lambda i: i.redelivered,
    "events_per_order": lambda i: reconcile.gateway_by_order(i.gateway).select(
        "order_id", "event_count", "success_event_count"
    ),
    "primary_gateway_event": lambda i: reconcile.gateway_by_order(i.gateway).select(
        "order_id", "txn_id", "gateway_status", "gateway_amount", "event_time"
    ),
    "settlement_per_txn": lambda i: reconcile.settlement_by_txn(i.redelivered, "payment"),
    "refund_per_txn": lambda i: reconcile.settlement_by_txn(i.redelivered, "refund"),
    "orphan_payments": lambda i: reconcile.orphan_payments(i.settled, i.orders, i.hot_orders),
    "fact_reconciliation": lambda i: i.fact,
    "affected_orders": lambda i: reconcile.affected_orders(i.orders, i.gateway, i.settlements, LAST),
    "fact_reconciliation_incremental": lambda i: _kept(i).read(forward.FACT),
    "fact_payments_incremental": lambda i: _kept(i).read(forward.PAYMENTS),
    "stg_orders_incremental": lambda i: _kept_staging(i, "orders"),
    "stg_gateway_events_incremental": lambda i: _kept_staging(i, "gateway"),
    "daily_summary_incremental": lambda i: deltas.daily_from(_kept(i).read("sums/days"), i.run_log),
    "merchant_summary_incremental": lambda i: deltas.merchants_from(_kept(i).read("sums/merchants"), i.dim_merchants),
    "accuracy_incremental": lambda i: deltas.accuracy_from(_kept(i).read("sums/detectors"), i.run_log),
    "fact_payments": lambda i: i.payments,
    "payments_ledger": lambda i: payments.ledger(i.payments),
    "daily_summary": lambda i: i.daily,
    "status_trend": lambda i: marts.status_trend(i.daily),
    "discrepancy_rate_trend": lambda i: marts.discrepancy_rate_trend(i.daily),
    "discrepancy_aging": lambda i: marts.discrepancy_aging(i.daily),
    "unsettled_amount": lambda i: marts.unsettled_trend(i.daily),
    "merchant_summary": lambda i: i.merchant_summary,
    "merchant_leaderboard": lambda i: marts.merchant_leaderboard(i.merchant_summary),
    "merchant_flag_breakdown": lambda i: marts.merchant_flag_breakdown(i.merchant_summary),
    "accuracy_by_error_type": lambda i: i.accuracy,
    "merchants_scd2": _scd2,
    "dim_merchants_current": lambda i: i.dim_merchants.where("is_current"),
    "fee_as_of_order": lambda i: dimensions.fee_as_of(i.orders, i.snapshot, i.hot_merchants).select(
        "order_id", "merchant_id", "created_at", "fee_rate"
    ),
    "dim_date": _order_days,
    "dq_not_null": _not_null,
    "dq_unique": _unique,
    "dq_accepted_values": _accepted,
    "dq_relationships": _relationships,
    "dq_answer_key": lambda i: quality.answer_key_disagreements(
        marts.matured(i.fact, i.run_log), i.answer_key, i.hot_orders
    ),
    "dq_answer_key_planted": lambda i: quality.answer_key_disagreements(
        marts.matured(i.fact, i.run_log), _misled(i.answer_key), i.hot_orders
    ),
    "dq_negative_amounts": _negative,
    "dq_volume_anomaly": _volume,
    "dq_orphan_settlements": lambda i: quality.orphan_settlements(i.settlements, i.gateway, i.hot_txns),
    "dq_report": lambda i: quality.run_checks(i.tables(_TABLES)),
    "raw_day_replace": _day_replace,
    "orders_upsert": _upsert,
    "settlement_fee_check": _fee_check,
    "answer_key": lambda i: i.answer_key,
    "run_log": lambda i: rules.run_log_by_day(list(i.all_checked().values())),
    "headline_metrics": _headline,
    "reconciliation_drilldown": lambda i: marts.drilldown(
        i.fact, status="discrepancy", start=fixtures.day(2), end=fixtures.day(6)
    ),
}


def _query(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: publish(build(Inputs(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(build) for name, build in _BUILDERS.items()}
