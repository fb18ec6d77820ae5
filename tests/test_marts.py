import datetime as dt

from pyspark.sql import functions as F

from conftest import SMALL, at, by, day
from ledgerline.functions.money import percent, ratio
from ledgerline.operators import marts
from ledgerline.operators.dimensions import dim_merchants
from ledgerline.plans.catalogue import Inputs
from ledgerline.sources.extract import as_text, orders_incremental_pull


def test_ratios_round_half_up_and_guard_zero(spark):
    df = spark.createDataFrame([(1, 8), (2469, 20000), (1, 0), (0, 7), (-1, 8)], "a long, b long")
    got = [r for r in df.select(ratio(F.col("a"), F.col("b"), 2), percent(F.col("a"), F.col("b"))).collect()]
    assert [[x if x is None else str(x) for x in r] for r in got] == [
        ["0.13", "12.50"], ["0.12", "12.35"], [None, None], ["0.00", "0.00"], ["-0.13", "-12.50"],
    ]


def test_daily_totals(spark):
    i = Inputs(spark, SMALL)
    rows = by(i.daily, "report_date")
    assert len(rows) == 10 and sum(r["total_orders"] for r in rows) == 1500
    assert str(sum(r["total_net_settled"] or 0 for r in rows)) == "267719037.40"
    assert str(sum(r["unsettled_amount"] or 0 for r in rows)) == "39005537.87"
    for r in rows:
        parts = sum(r[f"{s}_count"] for s in ("matched", "discrepancy", "refunded", "pending"))
        assert parts == r["total_orders"]
        # One day's orders all have the same age.
        assert r["avg_discrepancy_age_days"] == r["max_discrepancy_age_days"] == (day(10) - r["report_date"]).days


def test_detectors(spark):
    got = {r.error_type: r for r in Inputs(spark, SMALL).accuracy.collect()}
    assert {k: (r.true_positives, r.false_positives, r.false_negatives) for k, r in got.items()} == {
        "missing_settlement": (10, 0, 1), "late_settlement": (11, 0, 0), "amount_mismatch": (5, 0, 0),
        "duplicate_charge": (6, 0, 0), "status_mismatch": (12, 5, 0),
    }
    assert str(got["status_mismatch"].precision) == "0.7059"


def test_null_flags_count_nowhere(spark):
    flags = ["is_missing_settlement", "is_late_settlement", "is_amount_mismatch", "is_duplicate_charge",
             "is_status_mismatch"]
    fact = spark.createDataFrame([("o1", at(1)), ("o2", at(1)), ("o3", at(9))], "order_id string, t timestamp")
    fact = fact.select(
        "order_id", F.lit(False).alias("is_orphan_payment"), F.lit(None).cast("timestamp").alias("gateway_event_time"),
        F.col("t").alias("order_created_at"),
        *[F.when(F.col("order_id") == "o2", True).cast("boolean").alias(f) for f in flags],
    )
    key = spark.createDataFrame(
        [("o1", "late_settlement"), ("o2", "late_settlement"), ("o3", "late_settlement")],
        "order_id string, error_type string",
    )
    log = spark.createDataFrame([(day(6),), (day(2),)], "run_date date")
    got = {r.error_type: r for r in marts.accuracy(fact, key, log).collect()}
    late = got["late_settlement"]
    assert (late.true_positives, late.false_positives, late.false_negatives) == (1, 0, 0)
    assert got["amount_mismatch"].false_positives == 1 and got["amount_mismatch"].recall is None


def test_cutoff_is_midnight(spark):
    log = spark.createDataFrame([(day(9),)], "run_date date")
    assert marts.maturity_cutoff(log).select(F.col("cutoff").cast("string")).first()[0] == "2026-09-04 00:00:00"


def test_merchants_without_current_row_are_left_out(spark):
    i = Inputs(spark, SMALL)
    dim = dim_merchants(i.snapshot.where("merchant_id <> 'M4' or valid_to is not null"))
    got = marts.merchant_summary(i.fact, dim)
    assert {r.merchant_id for r in got.collect()} == {f"M{n}" for n in range(10)} - {"M4"}


def test_leaderboard_breakdown_drilldown(spark):
    i = Inputs(spark, SMALL)
    board = marts.merchant_leaderboard(i.merchant_summary).collect()
    assert [r.discrepancy_rate_pct for r in board] == sorted([r.discrepancy_rate_pct for r in board], reverse=True)
    assert len(board) == i.merchant_summary.count() == 10
    assert marts.merchant_flag_breakdown(i.merchant_summary).count() == 50
    assert marts.drilldown(i.fact, order_id="ORD-1").count() == 1
    rows = marts.drilldown(i.fact, merchant_id="M1", start=day(2), end=day(2))
    assert {r.order_created_at.date() for r in rows.collect()} == {day(2)}
    # Orphans have no order date; they count on the day of their payment.
    orphans = i.fact.where("is_orphan_payment")
    days = {r.gateway_event_time.date() for r in orphans.collect()}
    found = marts.drilldown(i.fact, start=min(days), end=max(days)).where("is_orphan_payment")
    assert found.count() == orphans.count() > 0


def test_incremental_pull_takes_the_day_and_its_text_reads_back(spark):
    o = spark.createDataFrame(
        [("a", at(2)), ("b", at(2, 23, 59)), ("c", at(3)), ("d", at(1, 23, 59))], "order_id string, updated_at timestamp"
    ).select(
        "order_id", *[F.lit("x").alias(c) for c in ("merchant_id", "customer_vpa", "status")],
        F.lit(1).cast("decimal(12,2)").alias("amount"), F.col("updated_at").alias("created_at"), "updated_at",
    )
    pulled = orders_incremental_pull(o, dt.date(2026, 9, 2))
    assert sorted(r.order_id for r in pulled.collect()) == ["a", "b"]
    text = {r.order_id: r for r in as_text(pulled).collect()}
    assert text["b"].updated_at.startswith("2026-09-02T23:59:00") and text["b"].amount == "1.00"


def test_headline_metrics_hold_the_ingest_seconds(spark):
    i = Inputs(spark, SMALL)
    log = spark.createDataFrame(
        [("extract", 10, 0, 0.5), ("validate", 10, 1, 0.25), ("load", 9, 0, 1.0), ("marts", 0, 0, 60.0)],
        "step string, rows_in long, rows_rejected long, duration_seconds double",
    )
    found = {r.metric: r.value for r in marts.headline_metrics(i.fact, log, i.accuracy).collect()}
    assert found["ingest_seconds"] == 1.75 and found["rejected_pct"] == 10.0
