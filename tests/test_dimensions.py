import datetime as dt

from pyspark.sql import functions as F

from conftest import SMALL, at, by, same
from ledgerline.operators import dimensions as dim
from ledgerline.operators import skew
from ledgerline.plans.catalogue import Inputs

MERCHANT = "merchant_id string, fee_rate decimal(6,4), updated_at timestamp"


def merchants(spark, *rows):
    return spark.createDataFrame(
        [(m, str(f), t) for m, f, t in rows], "merchant_id string, fee string, updated_at timestamp"
    ).select("merchant_id", F.col("fee").cast("decimal(6,4)").alias("fee_rate"), "updated_at")


def spans(df):
    naive = lambda t: t and (t.day, t.hour)
    return [
        (r["merchant_id"], float(r["fee_rate"]), naive(r["valid_from"]), naive(r["valid_to"]))
        for r in by(df, "merchant_id", "valid_from")
    ]


def test_merge_closes_opens_inserts_and_keeps(spark):
    empty = dim.chain_versions(merchants(spark, ("A", 0.1, at(1))), "merchant_id", "updated_at").limit(0)
    first = dim.scd2_merge(
        empty, merchants(spark, ("A", 0.01, at(1)), ("B", 0.02, at(1)), ("C", 0.03, at(1))),
        "merchant_id", "updated_at",
    )
    second = dim.scd2_merge(
        first, merchants(spark, ("A", 0.05, at(3, 12)), ("B", 0.02, at(1)), ("D", 0.04, at(3))),
        "merchant_id", "updated_at",
    )
    expected = [
        ("A", 0.01, (1, 0), (3, 12)), ("A", 0.05, (3, 12), None), ("B", 0.02, (1, 0), None),
        ("C", 0.03, (1, 0), None), ("D", 0.04, (3, 0), None),
    ]
    assert spans(second) == expected
    # The same source again changes nothing, and neither does an older state.
    again = dim.scd2_merge(second, merchants(spark, ("A", 0.05, at(3, 12))), "merchant_id", "updated_at")
    older = dim.scd2_merge(again, merchants(spark, ("A", 0.09, at(2))), "merchant_id", "updated_at")
    assert spans(again) == spans(older) == expected


def test_every_key_has_one_current_row_and_no_overlap(spark):
    snapshot = Inputs(spark, SMALL).snapshot
    assert snapshot.count() == 37
    current = snapshot.where("valid_to is null")
    assert current.count() == current.select("merchant_id").distinct().count() == 10
    other = snapshot.select("merchant_id", F.col("valid_from").alias("f"), F.col("valid_to").alias("t"))
    overlaps = snapshot.join(other, "merchant_id").where(
        "valid_from < f and (valid_to is null or valid_to > f)"
    )
    assert overlaps.count() == 0


def test_chain_spans_days_and_hours(spark):
    history = merchants(
        spark, ("A", 0.01, at(1)), ("A", 0.02, at(1, 5)), ("A", 0.03, at(1, 9)), ("A", 0.04, at(4)), ("B", 0.09, at(2)),
    )
    assert spans(dim.chain_versions(history, "merchant_id", "updated_at")) == [
        ("A", 0.01, (1, 0), (1, 5)), ("A", 0.02, (1, 5), (1, 9)), ("A", 0.03, (1, 9), (4, 0)),
        ("A", 0.04, (4, 0), None), ("B", 0.09, (2, 0), None),
    ]


def test_fee_as_of_matches_brute_force_with_a_hot_merchant(spark):
    i = Inputs(spark, SMALL)
    i.store_staging()
    orders = i.orders.withColumn(
        "merchant_id", F.when(F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0, "M3").otherwise(F.col("merchant_id"))
    ).withColumn("merchant_id", F.when(F.col("order_id") == "ORD-5", None).otherwise(F.col("merchant_id")))
    hot = skew.hot_keys(orders, "merchant_id", share=0.2)
    assert [r[0] for r in hot.collect()] == ["M3"]
    got = dim.fee_as_of(orders, i.snapshot, hot)
    v = i.snapshot.select("merchant_id", "valid_from", "valid_to", "fee_rate")
    brute = orders.join(v, "merchant_id", "left").where(
        "valid_from is null or (valid_from <= created_at and (valid_to is null or created_at < valid_to))"
    ).select(*orders.columns, "fee_rate")
    assert got.count() == orders.count()
    assert same(got, brute)
    assert got.where("order_id = 'ORD-5'").first().fee_rate is None


def test_fee_bounds_are_closed_open(spark):
    v = spark.createDataFrame(
        [("A", "0.01", at(2), at(3)), ("A", "0.02", at(3), at(4))],
        "merchant_id string, f string, valid_from timestamp, valid_to timestamp",
    ).select("merchant_id", F.col("f").cast("decimal(6,4)").alias("fee_rate"), "valid_from", "valid_to")
    o = spark.createDataFrame(
        [("o1", "A", at(1)), ("o2", "A", at(2)), ("o3", "A", at(3)), ("o4", "A", at(4)), ("o5", "Z", at(3))],
        "order_id string, merchant_id string, created_at timestamp",
    )
    got = {r.order_id: r.fee_rate and float(r.fee_rate) for r in dim.fee_as_of(o, v).collect()}
    assert got == {"o1": None, "o2": 0.01, "o3": 0.02, "o4": None, "o5": None}


def test_calendar(spark):
    d = dim.dim_date(spark)
    assert d.count() == 2557 and d.select("date_day").distinct().count() == 2557
    r = d.where(F.col("date_day") == F.lit(dt.date(2026, 9, 6))).first()
    assert (r.year, r.month, r.day_of_month, r.day_of_week, r.quarter, r.is_weekend) == (2026, 9, 6, 7, 3, True)
    assert (r.day_name, r.month_name) == ("Sunday   ", "September")


def test_fee_split_is_exact(spark):
    df = spark.sql("select cast(100.50 as decimal(12,2)) gross_amount, cast(0.0150 as decimal(6,4)) fee_rate")
    r = dim.settlement_fees(df, "fee_rate").first()
    assert [str(r[c]) for c in ("expected_mdr_fee", "expected_gst_on_fee", "expected_net_settled")] == [
        "1.51", "0.27", "98.72",
    ]
