"""The stored tables brought forward by one day's loads.

Kept between days are, each in buckets of a key: the newest row per order, transaction and
settlement; the settlements once more by transaction; the payments fact and the reconciliation
fact, both by order; and the sums behind the summaries. A day is followed from its raw rows to what they
change: keys of the day's rows, staged rows that really differ, transactions and orders of these, and the
buckets that hold them. Nothing else is read or written. All of it is one commit of ``Tables``.

A day that is loaded again first gives up the rows of its earlier load, so rows that have vanished
from it vanish everywhere.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import deltas, reconcile, staging
from ledgerline.operators.payments import payments_settled
from ledgerline.operators.skew import hot_keys
from ledgerline.session import materialize, together
from ledgerline.sources.tables import Tables

RAW = {"orders": "raw/orders", "gateway": "raw/gateway_events", "settlement": "raw/settlements"}
FACT = "marts/fact_reconciliation"
PAYMENTS = "marts/fact_payments"
LINES = "staging/settlements_by_txn"
ANSWER_KEY = "staging/answer_key"


@dataclass(frozen=True)
class Latest:
    """A kept table of newest rows: where its loads are, its key, and the columns that are published."""

    raw: str
    table: str
    key: str
    view: Callable[[DataFrame], DataFrame]


LATEST = {
    "orders": Latest(RAW["orders"], "staging/orders", "order_id", staging.orders_view),
    "gateway": Latest(RAW["gateway"], "staging/gateway_events", "txn_id", staging.gateway_view),
    "settlement": Latest(RAW["settlement"], "staging/settlements", "settlement_id", staging.settlements_view),
}


@dataclass(frozen=True)
class Sums:
    """A kept table of sums: the key, the count of rows in a group, and what signed fact rows add to it."""

    table: str
    key: str
    rows: str
    of: Callable[[Tables, DataFrame], DataFrame]


SUMS = (
    Sums("sums/days", "report_date", "total_orders", lambda tables, rows: deltas.day_sums(rows)),
    Sums("sums/merchants", "merchant_id", "total_orders", lambda tables, rows: deltas.merchant_sums(rows)),
    Sums("sums/detectors", "seen_by", "orders", lambda tables, rows: deltas.detector_sums(rows, tables.read(ANSWER_KEY))),
)


def staged(tables: Tables) -> dict[str, DataFrame]:
    """The staging views of the kept tables, by source."""
    return {name: kept.view(tables.read(kept.table)) for name, kept in LATEST.items()}


def is_kept(tables: Tables) -> bool:
    """Whether there is something to bring forward."""
    return all(tables.exists(name) for name in (*[k.table for k in LATEST.values()], LINES, PAYMENTS, FACT))


# A payment without an order has a bucket by its transaction.
def _payment_key():
    return F.coalesce("order_id", "txn_id")


def rebuild(tables: Tables) -> None:
    """Compute every kept table anew from the loads."""
    with tables.commit():
        def newest(kept: Latest) -> None:
            latest = staging.latest_by(tables.read(kept.raw), kept.key, staging.NEWEST_LOAD)
            tables.put(kept.table, latest, tables.bucket(kept.key))

        together(*[partial(newest, kept) for kept in LATEST.values()])
        now = staged(tables)
        lines = now["settlement"].where(F.col("txn_id").isNotNull()).drop("run_date")
        hot = hot_keys(now["gateway"], "order_id")
        settled = reconcile.settled_gateway(now["gateway"], now["settlement"])
        paid = payments_settled(now["orders"], settled, hot)
        together(
            lambda: tables.put(LINES, lines, tables.bucket("txn_id")),
            lambda: tables.put(PAYMENTS, paid, tables.bucket(_payment_key())),
        )
        fact = reconcile.reconcile_payments(now["orders"], tables.read(PAYMENTS))
        fact = tables.put(FACT, fact, tables.bucket("order_id")).withColumn(deltas.SIGN, F.lit(1))
        together(*[lambda s=s: tables.put(s.table, s.of(tables, fact).where(F.col(s.rows) != 0)) for s in SUMS])


@dataclass(frozen=True)
class Step:
    """What a day does to one table of newest rows: its touched buckets, (key, old, new) rows of all that is in
    them, of the day's keys, and of those whose staged row differs."""

    parts: list[str]
    every: DataFrame
    rows: DataFrame
    changed: DataFrame


def _packed(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(key, F.struct(*df.columns).alias(name))


def _step(tables: Tables, kept: Latest, run_date: dt.date) -> Step:
    day = str(run_date)
    now, then = (tables.parts(kept.raw, before).get(day) for before in (False, True))
    again = then is not None and then != now
    # A source that has nothing new for the day changes nothing.
    today = tables.read(kept.raw, parts=[day] if then != now else [])
    keys = today.select(kept.key)
    if again:
        keys = keys.union(tables.read(kept.raw, parts=[day], before=True).select(kept.key))
    keys = keys.where(F.col(kept.key).isNotNull()).distinct()
    parts = tables.buckets_of(keys, kept.key)
    held = tables.read(kept.table, parts=parts)
    others = [p for p in tables.parts(kept.raw) if p != day] if again else []
    # The kept rows meet the day once: what comes out of it is both what is stored and what has changed.
    every = materialize(staging.advanced(held, today, tables.read(kept.raw, parts=others), keys, kept.key, run_date), "rows")
    rows = every.where("touched").drop("touched")
    # The day of load is not part of what is published further on.
    views = [_packed(kept.view(rows.where(F.col(n).isNotNull()).select(f"{n}.*")).drop("run_date"), kept.key, n) for n in ("old", "new")]
    seen = rows.select(kept.key).join(views[0], kept.key, "left").join(views[1], kept.key, "left")
    changed = materialize(seen.where(~F.col("old").eqNullSafe(F.col("new"))), "changed")
    return Step(parts, every, rows, changed)


def _keep(tables: Tables, kept: Latest, step: Step) -> None:
    fresh = step.every.where(F.col("new").isNotNull()).select("new.*")
    tables.put(kept.table, fresh, tables.bucket(kept.key), step.parts)


def _of(changed: DataFrame, *columns: str) -> DataFrame:
    """The values of fields of the old and the new rows."""
    frames = [changed.select(F.col(c).alias("value")) for c in columns]
    return reduce(DataFrame.union, frames).where(F.col("value").isNotNull())


def advance(tables: Tables, run_date: dt.date) -> None:
    """Bring all kept tables forward by the loads of ``run_date``, which are in the same commit."""
    with tables.commit():
        steps = together(*[partial(_step, tables, kept, run_date) for kept in LATEST.values()])
        orders, gateway, settlement = (step.changed for step in steps)

        # Settlement lines by transaction: those of changed settlements out, the new ones in.
        line_txns = _of(settlement, "old.txn_id", "new.txn_id").distinct().withColumnRenamed("value", "txn_id")

        def keep_lines() -> None:
            parts = tables.buckets_of(line_txns, "txn_id")
            kept = tables.read(LINES, parts=parts).join(settlement.select("settlement_id"), "settlement_id", "left_anti")
            renewed = steps[2].rows.join(settlement.select("settlement_id"), "settlement_id", "left_semi").where(F.col("new.txn_id").isNotNull())
            renewed = staging.settlements_view(renewed.select("new.*")).drop("run_date")
            tables.put(LINES, kept.unionByName(renewed), tables.bucket("txn_id"), parts)

        together(keep_lines, *[partial(_keep, tables, kept, step) for kept, step in zip(LATEST.values(), steps)])

        # Transactions to compute anew: changed, settled anew, or of a changed order.
        order_ids = orders.select("order_id")
        of_orders = tables.read(PAYMENTS, parts=tables.buckets_of(order_ids, "order_id"))
        txns = materialize(
            gateway.select("txn_id").union(line_txns).union(of_orders.join(order_ids, "order_id", "left_semi").select("txn_id")).distinct(), "txns"
        )
        txn_parts = tables.buckets_of(txns, "txn_id")
        events = staging.gateway_view(tables.read(LATEST["gateway"].table, parts=txn_parts))
        events = materialize(events.join(txns, "txn_id", "left_semi"), "events")
        lines = tables.read(LINES, parts=txn_parts).join(txns, "txn_id", "left_semi")
        placed = events.select("order_id").where(F.col("order_id").isNotNull()).distinct()
        known = staging.orders_view(tables.read(LATEST["orders"].table, parts=tables.buckets_of(placed, "order_id")))
        fresh = materialize(payments_settled(
            known.join(placed, "order_id", "left_semi"), reconcile.settled_gateway(events, lines), hot_keys(events, "order_id")
        ), "payments")

        def paid_now(parts: list[str]) -> DataFrame:
            """The payments fact as it will be, in some buckets."""
            kept = tables.read(PAYMENTS, parts=parts, before=True).join(txns, "txn_id", "left_anti")
            return kept.unionByName(fresh.where(tables.bucket(_payment_key()).isin(parts)))

        # Orders to compute anew.
        touched = order_ids.union(placed).union(_of(gateway, "old.order_id", "new.order_id")).where(F.col("order_id").isNotNull())
        touched = materialize(touched.distinct(), "touched")
        parts = tables.buckets_of(touched, "order_id")
        # Stored rows on one side and distinct keys on the other: a key that fills a partition is split by AQE.
        stored = tables.read(FACT, parts=parts)
        known = staging.orders_view(tables.read(LATEST["orders"].table, parts=parts)).join(touched, "order_id", "left_semi")
        gone, paid = together(
            lambda: materialize(stored.join(touched, "order_id", "left_semi"), "gone"),
            lambda: materialize(paid_now(parts).join(touched, "order_id", "left_semi"), "paid"),
        )
        come = materialize(reconcile.reconcile_payments(known, paid), "come")

        def keep_payments() -> None:
            places = fresh.select("order_id", "txn_id").union(gateway.where(F.col("old").isNotNull()).select("old.order_id", "txn_id"))
            parts = tables.buckets_of(places, _payment_key())
            tables.put(PAYMENTS, paid_now(parts), tables.bucket(_payment_key()), parts)

        together(
            keep_payments,
            lambda: tables.put(FACT, stored.join(touched, "order_id", "left_anti").unionByName(come), tables.bucket("order_id"), parts),
            *[partial(_advance_sums, tables, sums, gone, come) for sums in SUMS],
        )


def _advance_sums(tables: Tables, sums: Sums, gone: DataFrame, come: DataFrame) -> None:
    if tables.exists(sums.table):
        change = sums.of(tables, deltas.signed(gone, come))
        tables.put(sums.table, deltas.add(tables.read(sums.table), change, sums.key, sums.rows))


def restore_sums(tables: Tables) -> None:
    """Compute sums that are not there, as those of the detectors after their labels were replaced."""
    fact = tables.read(FACT).withColumn(deltas.SIGN, F.lit(1))
    for sums in SUMS:
        if not tables.exists(sums.table):
            tables.put(sums.table, sums.of(tables, fact).where(F.col(sums.rows) != 0))
