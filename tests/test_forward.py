"""Tables brought forward day by day are those computed anew from all loads."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, at, day, same
from ledgerline.operators import deltas, dimensions, marts, payments, reconcile, staging
from ledgerline.plans import fixtures, forward
from ledgerline.plans.catalogue import Inputs
from ledgerline.schemas import RAW_GATEWAY, RAW_ORDERS, RAW_SETTLEMENTS
from ledgerline.sources.tables import Tables


def run_log(spark, n):
    return spark.createDataFrame([(fixtures.day(n),)], "run_date date")


def check(spark, tables, n, dim):
    """Every kept table against the operators over all loads."""
    raw = {name: tables.read(path) for name, path in forward.RAW.items()}
    orders, gateway = staging.stg_orders(raw["orders"]), staging.stg_gateway_events(raw["gateway"])
    settlements = staging.stg_settlements(raw["settlement"])
    now = forward.staged(tables)
    for name, want in (("orders", orders), ("gateway", gateway), ("settlement", settlements)):
        assert same(now[name], want), (n, name)
    assert same(tables.read(forward.LINES), settlements.where("txn_id is not null").drop("run_date")), n
    fact = reconcile.reconcile(orders, gateway, settlements).cache()
    assert same(tables.read(forward.FACT), fact), n
    assert same(tables.read(forward.PAYMENTS), payments.payments(orders, gateway, settlements)), n
    log, key = run_log(spark, n), tables.read(forward.ANSWER_KEY)
    assert same(deltas.daily_from(tables.read("sums/days"), log), marts.daily_summary(fact, log)), n
    assert same(deltas.merchants_from(tables.read("sums/merchants"), dim), marts.merchant_summary(fact, dim)), n
    assert same(deltas.accuracy_from(tables.read("sums/detectors"), log), marts.accuracy(fact, key, log)), n
    fact.unpersist()


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SMALL)


@pytest.fixture(scope="module")
def dim(inputs):
    return dimensions.dim_merchants(inputs.snapshot).cache()


@pytest.fixture
def tables(spark, inputs, tmp_path):
    """Six days, built anew, in a few buckets."""
    tables = Tables(spark, str(tmp_path), buckets=5)
    with tables.commit():
        tables.overwrite(forward.ANSWER_KEY, inputs.answer_key)
        for path, df in loads(inputs).items():
            tables.load_days(path, df.where(F.col("run_date") < F.lit(fixtures.day(6))))
        forward.rebuild(tables)
    return tables


def loads(i):
    return {forward.RAW["orders"]: i.raw_orders, forward.RAW["gateway"]: i.raw_gateway, forward.RAW["settlement"]: i.raw_settlements}


def test_days_and_repeats(spark, inputs, tables, dim):
    def load(n, change=lambda path, df: df):
        with tables.commit():
            for path, df in loads(inputs).items():
                tables.replace_day(path, change(path, df.where(F.col("run_date") == F.lit(fixtures.day(n)))), fixtures.day(n))
            forward.advance(tables, fixtures.day(n))
        check(spark, tables, n, dim)

    load(6)

    def poorer(path, df):
        """A load again, later, with a third of its rows gone and others changed."""
        key = {"raw/orders": "order_id", "raw/gateway_events": "txn_id", "raw/settlements": "settlement_id"}[path]
        df = df.where(F.crc32(key) % 3 != 0).withColumn("ingested_at", F.lit(at(28)))
        if path == "raw/gateway_events":
            # Some payments go to other orders, some to none, and one key holds very many.
            other = F.when(F.crc32("order_id") % 5 == 0, F.lit("ghost")).when(F.crc32("order_id") % 5 == 1, None)
            df = df.withColumn("order_id", F.when(F.crc32("order_id") % 5 > 1, F.col("order_id")).otherwise(other))
        if path == "raw/settlements":
            df = df.withColumn("txn_id", F.when(F.crc32("txn_id") % 7 == 0, F.lit("T-moved")).otherwise(F.col("txn_id")))
        return df

    load(6, poorer)
    load(8, lambda path, df: df.limit(0))


def test_an_order_that_comes_later_ends_an_orphan(spark, inputs, tables, dim):
    lost = tables.read(forward.FACT).where("is_orphan_payment").orderBy("order_id").limit(3).select("order_id").collect()
    assert lost
    day = fixtures.day(6)
    orders = spark.createDataFrame([(r.order_id, "M1", "v", None, "paid", at(7), at(7), at(8), day) for r in lost], RAW_ORDERS)
    with tables.commit():
        tables.replace_day("raw/orders", orders, day)
        tables.replace_day("raw/gateway_events", spark.createDataFrame([], RAW_GATEWAY), day)
        tables.replace_day("raw/settlements", spark.createDataFrame([], RAW_SETTLEMENTS), day)
        forward.advance(tables, day)
    check(spark, tables, 6, dim)
    ids = [r.order_id for r in lost]
    assert tables.read(forward.FACT).where(F.col("order_id").isin(ids) & F.col("is_orphan_payment")).count() == 0
    assert tables.read(forward.PAYMENTS).where(F.col("order_id").isin(ids) & F.col("is_orphan_payment")).count() == 0


def test_a_small_day_rewrites_its_buckets_only(spark, inputs, tables):
    """One changed order in a hundred buckets' worth of tables."""
    wide = Tables(spark, tables.root + "-wide", buckets=16)
    with wide.commit():
        for path, df in loads(inputs).items():
            wide.load_days(path, df.where(F.col("run_date") < F.lit(fixtures.day(6))))
        forward.rebuild(wide)
    before = {name: wide.parts(name) for name in ("staging/orders", "staging/gateway_events", forward.LINES, forward.FACT, forward.PAYMENTS)}
    paid = wide.read(forward.FACT).where("order_status = 'paid' and txn_id is not null").orderBy("order_id").first()
    one = wide.read("raw/orders").where(F.col("order_id") == paid.order_id).limit(1)
    with wide.commit():
        wide.replace_day("raw/orders", one.withColumn("status", F.lit("refunded")).withColumn("ingested_at", F.lit(at(28))), fixtures.day(6))
        forward.advance(wide, fixtures.day(6))
    changed = {name: {p for p, f in wide.parts(name).items() if f != parts.get(p)} for name, parts in before.items()}
    assert changed["staging/gateway_events"] == changed[forward.LINES] == set()
    assert len(changed["staging/orders"]) == len(changed[forward.FACT]) == len(changed[forward.PAYMENTS]) == 1
    assert wide.read(forward.FACT).where(F.col("order_id") == paid.order_id).first().order_status == "refunded"


def test_labels_replaced_afterwards(spark, inputs, tables):
    with tables.commit():
        tables.overwrite(forward.ANSWER_KEY, inputs.answer_key.where(F.crc32("order_id") % 2 == 0))
        tables.drop("sums/detectors")
    forward.restore_sums(tables)
    log, key = run_log(spark, 9), tables.read(forward.ANSWER_KEY)
    assert same(deltas.accuracy_from(tables.read("sums/detectors"), log), marts.accuracy(tables.read(forward.FACT), key, log))


def test_kept_rows_meet_a_day_once(spark):
    held = spark.createDataFrame(
        [("a", 1, day(1), at(2)), ("b", 2, day(2), at(3)), ("c", 3, day(2), at(3)), ("d", None, day(1), at(2)), ("e", 5, day(1), None)],
        "k string, v int, run_date date, ingested_at timestamp",
    )
    today = spark.createDataFrame(
        [("a", 9, at(3), day(2)), ("b", 7, at(1), day(2)), ("d", 4, at(2), day(1)), ("e", 6, at(9), day(2)), ("f", 8, at(3), day(2))],
        "k string, v int, ingested_at timestamp, run_date date",
    )
    earlier = held.select("k", (F.col("v") + 100).alias("v"), F.lit(day(1)).alias("run_date"), F.lit(at(1)).alias("ingested_at"))
    keys = spark.createDataFrame([(k,) for k in "abcdefg"], "k string")
    met = {r.k: r for r in staging.advanced(held.unionByName(held.limit(1).withColumn("k", F.lit("z"))), today, earlier, keys, "k", day(2)).collect()}
    # Newer; the day's earlier rows are given up for the day's and for other days'; NULLs come first; kept; new; unknown.
    assert {k: r.new and r.new.v for k, r in met.items()} == {"a": 9, "b": 7, "c": 103, "d": None, "e": 5, "f": 8, "g": None, "z": 1}
    assert {k: r.old and r.old.v for k, r in met.items()} == {"a": 1, "b": 2, "c": 3, "d": None, "e": 5, "f": None, "g": None, "z": None}
    assert met["d"].new is not None and met["g"].new is None and [k for k, r in met.items() if not r.touched] == ["z"]
