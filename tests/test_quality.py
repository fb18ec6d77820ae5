import pytest
from pyspark.sql import functions as F

from conftest import SMALL, day
from ledgerline.operators import quality as q
from ledgerline.plans import catalogue
from ledgerline.plans.catalogue import Inputs


@pytest.fixture(scope="module")
def tables(spark):
    return Inputs(spark, SMALL).tables(catalogue._TABLES)


def keyed(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def test_row_checks(spark):
    df = keyed(spark, "a", "a", "b", None, None)
    assert q.not_null(df, "k").count() == 2
    assert [tuple(r) for r in q.unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in q.accepted_values(df, "k", ("a",)).collect()] == [("b", 1)]
    missing = q.relationships(df, "k", keyed(spark, "b", "b"), "k")
    assert [r.k for r in missing.collect()] == ["a", "a"]
    assert q.relationships(df, "k", keyed(spark, "b"), "k", F.col("k") == "b").count() == 0


def test_all_checks_report_once(tables):
    report = {r.check_name: r for r in q.run_checks(tables).collect()}
    assert len(report) == 38
    kinds = [name.split(".")[0] for name in report]
    assert [kinds.count(k) for k in ("not_null", "unique", "accepted_values", "relationships")] == [18, 9, 6, 1]
    assert {n: r.failures for n, r in report.items() if r.failures} == {"no_orphan_settlements": 10}
    assert {n for n, r in report.items() if r.severity == "warn"} == {
        "no_orphan_settlements", "no_daily_row_count_anomaly",
    }


def test_errors_stop_and_warnings_do_not(spark):
    report = spark.createDataFrame(
        [("a", "warn", 5), ("b", "error", 0)], "check_name string, severity string, failures long"
    )
    q.raise_on_errors(report)
    with pytest.raises(q.QualityError, match="c: 2"):
        q.raise_on_errors(report.unionByName(spark.createDataFrame([("c", "error", 2)], report.schema)))


def test_disagreement_is_found(tables):
    fact, key = tables["fact_reconciliation"], tables["answer_key"]
    matured = q.matured(fact, tables["run_log"])
    assert q.answer_key_disagreements(matured, key).count() == 0
    wrong = key.withColumn(
        "expected_result", F.when(F.col("order_id") == "ORD-1", "pending").otherwise(F.col("expected_result"))
    )
    assert q.answer_key_disagreements(matured, wrong).count() == 1


def test_negative_amounts_and_orphans(spark, tables):
    o = tables["stg_orders"].withColumn("amount", F.when(F.col("order_id") == "ORD-1", -1).otherwise(F.col("amount")))
    got = q.negative_amounts(o, tables["stg_gateway_events"]).collect()
    assert [(r.source, r.id) for r in got] == [("order", "ORD-1")]
    s = tables["stg_settlements"].withColumn(
        "txn_id", F.when(F.col("settlement_id") == "SET-11", None).otherwise(F.col("txn_id"))
    )
    assert s.where("txn_id is null").count() == 1
    assert q.orphan_settlements(s, tables["stg_gateway_events"]).count() == 11


def test_volume_swings(spark):
    daily = spark.createDataFrame(
        [(day(1), 100), (day(2), 150), (day(3), 74), (day(4), 112), (day(5), 0), (day(6), 5)],
        "report_date date, total_orders long",
    )
    got = {r.report_date.day: r.pct_change for r in q.volume_anomalies(daily).collect()}
    assert {k: v and str(v) for k, v in got.items()} == {3: "-50.7", 4: "51.4", 5: "-100.0", 6: None}
