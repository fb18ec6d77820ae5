import math

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, at, by, day, same
from ledgerline.operators import payments as pay
from ledgerline.operators import reconcile as rec
from ledgerline.operators import skew, staging
from ledgerline.plans import fixtures
from ledgerline.plans.catalogue import Inputs
from ledgerline.schemas import GATEWAY, ORDERS, RAW_ORDERS, SETTLEMENTS
from ledgerline.session import materialize


def orders(spark, *rows):
    """(id, amount, status) triples."""
    data = [(i, "M1", "a@b", amount, status, at(1, 9), at(1, 9), day(1)) for i, amount, status in rows]
    df = spark.createDataFrame(
        [(*r[:3], str(r[3]), *r[4:]) for r in data],
        "order_id string, merchant_id string, customer_vpa string, amount string, status string,"
        " created_at timestamp, updated_at timestamp, run_date date",
    )
    return df.withColumn("amount", F.col("amount").cast("decimal(12,2)")).select(
        *ORDERS.fieldNames(), "run_date"
    )


def gateway(spark, *rows):
    """(txn, order, status, amount, minute) tuples."""
    return spark.createDataFrame(
        [(t, o, s, str(a), None if m is None else at(1, 10, m), "payment", day(1)) for t, o, s, a, m in rows],
        "txn_id string, order_id string, gateway_status string, amount string, event_time timestamp,"
        " event_type string, run_date date",
    ).withColumn("amount", F.col("amount").cast("decimal(12,2)")).select(*GATEWAY.fieldNames(), "run_date")


def settlements(spark, *rows):
    """(id, txn, gross, settled day, type) tuples."""
    money = [F.col(c).cast("decimal(12,2)").alias(c) for c in ("gross_amount", "mdr_fee", "gst_on_fee", "net_settled")]
    df = spark.createDataFrame(
        [(i, t, str(g), "0", "0", str(g), None if d is None else day(d), k, day(2)) for i, t, g, d, k in rows],
        "settlement_id string, txn_id string, gross_amount string, mdr_fee string, gst_on_fee string,"
        " net_settled string, settled_date date, settlement_type string, run_date date",
    )
    return df.select("settlement_id", "txn_id", *money, "settled_date", "settlement_type", "run_date").select(
        *SETTLEMENTS.fieldNames(), "run_date"
    )


def test_every_status_and_flag(spark):
    o = orders(
        spark, ("ok", 10, "paid"), ("declined", 10, "failed"), ("new", 10, "created"), ("back", 10, "refunded"),
        ("unpaid", 10, "paid"), ("noevent", 10, "paid"), ("failnoevent", 10, "failed"), ("flip", 10, "failed"),
        ("twice", 10, "paid"), ("wrong", 10, "paid"), ("late", 10, "paid"), ("t1", 10, "paid"),
        ("notback", 10, "refunded"),
    )
    g = gateway(
        spark, ("T1", "ok", "success", 10, 0), ("T2", "declined", "failed", 10, 0), ("T4", "back", "success", 10, 0),
        ("T5", "unpaid", "success", 10, 0), ("T8", "flip", "success", 10, 0), ("T9", "twice", "failed", 10, 0),
        ("T9b", "twice", "success", 10, 5), ("T9c", "twice", "success", 10, 3), ("T10", "wrong", "success", 10, 0),
        ("T11", "late", "success", 10, 0), ("T12", "t1", "success", 10, 0), ("T13", "notback", "success", 10, 0),
        ("G1", "ghost", "success", 10, 0), ("G2", "ghost", "success", 10, 1), ("G3", "ghost2", "failed", 10, 0),
        ("G4", None, "success", 10, 0),
    )
    s = settlements(
        spark, ("S1", "T1", 10, 2, "payment"), ("S4", "T4", 10, 2, "payment"), ("R4", "T4", -10, 3, "refund"),
        ("S8", "T8", 10, 2, "payment"), ("S9", "T9c", 10, 2, "payment"), ("S10", "T10", 11, 2, "payment"),
        ("S11", "T11", 10, 3, "payment"), ("S12", "T12", 10, 2, "payment"), ("S13", "T13", 10, 2, "payment"),
        ("SG", "G1", 10, 2, "payment"), ("RG", "G1", -10, 3, "refund"),
    )
    fact = rec.reconcile(o, g, s)
    assert fact.columns == rec.FACT_COLS
    got = {(r.order_id, r.txn_id): r for r in fact.collect()}
    status = {k[0]: r.reconciliation_status for k, r in got.items()}
    assert status == {
        "ok": "matched", "declined": "matched", "new": "pending", "back": "refunded", "unpaid": "discrepancy",
        "noevent": "discrepancy", "failnoevent": "discrepancy", "flip": "discrepancy", "twice": "discrepancy",
        "wrong": "discrepancy", "late": "discrepancy", "t1": "matched", "notback": "discrepancy",
        "ghost": "discrepancy",
    }
    assert len(got) == 15 and ("ghost", "G2") in got
    # The earliest success is the primary event.
    assert got[("twice", "T9c")].event_count == 3 and got[("twice", "T9c")].is_duplicate_charge
    assert got[("unpaid", "T5")].is_missing_settlement
    assert got[("wrong", "T10")].is_amount_mismatch
    assert got[("late", "T11")].is_late_settlement and not got[("t1", "T12")].is_late_settlement
    # Unknown stays unknown.
    assert got[("noevent", None)].is_status_mismatch is True
    assert got[("noevent", None)].is_missing_settlement is None
    assert got[("failnoevent", None)].is_status_mismatch is None
    ghost = got[("ghost", "G1")]
    assert ghost.is_orphan_payment and ghost.settlement_id == "SG" and ghost.event_count == 1
    assert ghost.is_status_mismatch is None and not ghost.is_refunded and ghost.refund_settlement_id is None

    ledger = pay.payments(o, g, s)
    assert ledger.columns == pay.PAYMENT_FACT_COLS and ledger.count() == g.count()
    orphans = {r.txn_id for r in ledger.where("is_orphan_payment").collect()}
    assert orphans == {"G1", "G2", "G3", "G4"}
    assert ledger.where("txn_id = 'G1'").first().is_refunded
    assert same(fact, rec.reconcile_payments(o, ledger))


def test_null_times_sort_last_and_unknown_status_first(spark):
    g = gateway(
        spark, ("A", "o1", "success", 1, None), ("B", "o1", "success", 1, 9), ("C", "o2", "success", 1, 0),
        ("D", "o2", None, 1, 5), ("E", "o3", "failed", 1, 0), ("F", "o3", "failed", 1, 0),
    )
    got = {r.order_id: (r.txn_id, r.event_count) for r in rec.gateway_by_order(g).collect()}
    assert got == {"o1": ("B", 2), "o2": ("D", 2), "o3": ("E", 2)}
    s = settlements(
        spark, ("S1", "T", 5, None, "payment"), ("S2", "T", 6, 4, "payment"), ("S3", "T", 7, 4, "payment"),
        ("R1", "T", -5, 9, "refund"), ("S4", None, 5, 1, "payment"),
    )
    first = rec.settlements_per_txn(s).collect()
    assert [(r.txn_id, r.settlement_id, r.refund_settlement_id) for r in first] == [("T", "S2", "R1")]
    assert [r.settlement_id for r in rec.settlement_by_txn(s, "refund").collect()] == ["R1"]


def test_latest_load_wins_not_latest_update(spark):
    raw = spark.createDataFrame(
        [
            ("o1", "M1", "a", "created", at(5), at(9), at(1), day(1)),
            ("o1", "M1", "a", "paid", at(5), at(6), at(2), day(2)),
            ("o2", "M1", "a", "paid", at(5), at(6), at(1), day(1)),
            ("o2", "M1", "a", "failed", at(5), at(6), None, day(1)),
            (None, "M1", "a", "paid", at(5), at(6), at(1), day(1)),
        ],
        "order_id string, merchant_id string, customer_vpa string, status string, created_at timestamp,"
        " updated_at timestamp, ingested_at timestamp, run_date date",
    ).withColumn("amount", F.lit(1).cast("decimal(12,2)")).select(*RAW_ORDERS.fieldNames())
    got = {r.order_id: r.status for r in staging.stg_orders(raw).collect()}
    assert got == {"o1": "paid", "o2": "failed"}


def test_settlement_type_defaults_to_payment(spark):
    raw = settlements(spark, ("S1", "T1", 1, 2, None)).withColumn("ingested_at", F.lit(at(3)))
    assert staging.stg_settlements(raw).first().settlement_type == "payment"


@pytest.fixture(scope="module")
def inputs(spark):
    i = Inputs(spark, SMALL)
    i.store_staging()
    return i


def test_known_counts(inputs):
    fact = inputs.fact.cache()
    status = {r[0]: r[1] for r in fact.groupBy("reconciliation_status").count().collect()}
    assert status == {"matched": 1196, "discrepancy": 259, "refunded": 49, "pending": 3}
    flags = fact.agg(*[F.count_if(c) for c in rec.FLAGS]).first()
    assert tuple(flags) == (14, 26, 161, 15, 19, 51)
    nulls = fact.agg(*[F.count_if(F.col(c).isNull()) for c in ("is_status_mismatch", "is_missing_settlement")])
    assert tuple(nulls.first()) == (10, 18)
    assert fact.count() == inputs.orders.count() + fact.where("is_orphan_payment").count() == 1507
    assert inputs.payments.count() == 1504
    fact.unpersist()


def test_skewed_order_gives_the_same_result_through_salts(spark, inputs):
    """A third of the events on one unknown order, another share on a known one and on NULL."""
    slot = F.pmod(F.xxhash64("txn_id"), F.lit(10))
    g = inputs.gateway.withColumn(
        "order_id",
        F.when(slot < 4, "ORD-GHOST-HOT").when(slot == 4, "ORD-7").when(slot == 5, None).otherwise(F.col("order_id")),
    )
    hot = skew.hot_keys(g, "order_id")
    assert {r[0] for r in hot.collect()} == {"ORD-GHOST-HOT", "ORD-7"}
    none = hot.limit(0)
    args = inputs.orders, g, inputs.settlements
    assert same(pay.payments(*args, hot), pay.payments(*args, none))
    salted = rec.reconcile(*args, hot)
    assert same(salted, rec.reconcile(*args, none))
    plain = g.join(inputs.orders.select("order_id", F.lit(1).alias("k")), "order_id", "left").where(
        "k is null and order_id is not null and gateway_status = 'success'"
    )
    assert salted.where("is_orphan_payment").count() == plain.count() > 300


def test_hot_keys_are_spread_by_their_share(spark, inputs):
    g = inputs.gateway.withColumn("order_id", F.when(F.length("txn_id") < 7, "HOT").otherwise(F.col("order_id")))
    hot = skew.hot_keys(g, "order_id", share=0.01)
    rows = hot.where("order_id = 'HOT'").collect()
    part = g.where("order_id = 'HOT'").count() / g.where("order_id is not null").count()
    assert [r.salts for r in rows] == [math.ceil(part / 0.01)]
    salted = skew.salt_rows(g, "order_id", hot, "txn_id")
    assert salted.where("order_id = 'HOT'").select("_salt").distinct().count() == rows[0].salts
    copies = skew.copy_to_salts(inputs.orders.limit(5).withColumn("order_id", F.lit("HOT")), "order_id", hot)
    assert copies.count() == 5 * rows[0].salts


def test_hot_keys_follow_the_number_of_partitions(spark):
    """With 2,000 partitions a key of a thousandth of the rows fills two of them and is split."""
    df = spark.range(200_000).select(F.when(F.col("id") % 1000 == 7, "HOT").otherwise(F.col("id").cast("string")).alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        hot = skew.hot_keys(df, "k")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert [(r.k, r.salts) for r in hot.collect()] == [("HOT", 4)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert skew.hot_keys(df, "k").count() == 0


def test_hot_keys_are_bounded(spark):
    df = spark.range(5000).select((F.col("id") % 100).cast("string").alias("k"))
    assert skew.hot_keys(df, "k", share=0.01).count() == 100
    assert skew.hot_keys(df.where("k is null"), "k").count() == 0


def brought_forward(fact, orders, gateway, settlements, run_date, hot=None):
    """The fact with the orders that a day's loads touch computed anew."""
    keys = rec.affected_orders(orders, gateway, settlements, run_date)
    renewed = rec.reconcile_keys(orders, gateway, settlements, keys, hot)
    return materialize(fact.join(keys, "order_id", "left_anti").select(*fact.columns).unionByName(renewed), "fact")


def test_affected_orders_and_incremental_match_a_rebuild_every_day(spark, inputs):
    def staged(until):
        upto = F.col("run_date") <= F.lit(until)
        return (
            staging.stg_orders(inputs.raw_orders.where(upto)),
            staging.stg_gateway_events(inputs.raw_gateway.where(upto)),
            staging.stg_settlements(inputs.raw_settlements.where(upto)),
        )

    fact, sizes = None, []
    for offset in range(10):
        stored = [materialize(df, "stg") for df in staged(fixtures.day(offset))]
        full = materialize(rec.reconcile(*stored, inputs.hot_orders), "full")
        if not offset:
            fact = full
            continue
        sizes.append(rec.affected_orders(*stored, fixtures.day(offset)).count())
        for _ in range(2 if offset == 3 else 1):
            fact = brought_forward(fact, *stored, fixtures.day(offset), inputs.hot_orders)
            assert same(fact, full), offset
    assert all(200 < n < 300 for n in sizes[:4])


def test_settlements_are_cut_down_before_they_are_grouped(spark, inputs):
    keys = inputs.orders.limit(3).select("order_id")
    plan = rec.reconcile_keys(inputs.orders, inputs.gateway, inputs.settlements, keys, inputs.hot_orders)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in text.splitlines() if "min_by" in line and "settlement_type" in line]
    assert grouped and text.count("LeftSemi") >= len(grouped)


def test_orphan_is_replaced_when_its_order_arrives(spark):
    g = gateway(spark, ("T1", "o1", "success", 10, 0), ("T2", "o2", "success", 10, 0))
    none = settlements(spark, ("S0", "X", 1, 2, "payment"))
    before = rec.reconcile(orders(spark, ("o2", 10, "paid")), g, none)
    assert before.where("is_orphan_payment").count() == 1
    o = orders(spark, ("o1", 10, "paid"), ("o2", 10, "paid"))
    late = o.withColumn("run_date", F.when(F.col("order_id") == "o1", F.lit(day(5))).otherwise(F.col("run_date")))
    after = brought_forward(before, late, g, none, day(5))
    assert [(r["order_id"], r["is_orphan_payment"]) for r in by(after, "order_id")] == [("o1", False), ("o2", False)]
