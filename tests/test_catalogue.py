"""Every registered query against its SQL on DuckDB, and the plans of the hot paths."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import verify
from conftest import SMALL
from ledgerline.plans import catalogue, oracle
from ledgerline.plans.catalogue import Inputs

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


# Orders old enough to be judged all have the result of their label.
EMPTY = {"dq_answer_key"}


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    result = duck.sql(SQL[name])
    assert verify.type_clashes(df, zip(result.columns, result.types)) == []
    assert sorted(df.columns) == sorted(result.columns)
    got = verify.rows_of(df.columns, df.collect())
    assert got == verify.rows_of(result.columns, result.fetchall())
    assert bool(got) == (name not in EMPTY)


def test_entry(spark):
    rows = {r.reconciliation_status: r.payments for r in entry.entry(spark).collect()}
    assert rows == {"matched": 1196, "discrepancy": 259, "refunded": 49, "pending": 3}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_is_cut_down_before_the_shuffle(spark):
    text = plan(Inputs(spark, SMALL).orders)
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_no_join_is_a_product_and_orders_are_not_broadcast_by_hint(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(Inputs(spark, SMALL).fact)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # The only broadcast left is that of the hot keys, on both sides of the orphan join.
    assert text.count("BroadcastHashJoin") == 2
    assert text.count("SortMergeJoin") >= 2
    # Events and settlements are not read again: orders and orphans start from the settled events.
    assert "settlement_type" not in text


def test_a_check_stores_only_what_it_reads(spark, monkeypatch):
    stored = []
    real = catalogue.materialize
    monkeypatch.setattr(catalogue, "materialize", lambda df, label: stored.append(label) or real(df, label))
    QUERIES["dq_accepted_values"](spark, SMALL)
    assert not {"daily", "merchant_summary", "accuracy", "dim_merchants"} & set(stored)


def test_incremental_pull_reaches_the_scan(spark):
    text = plan(QUERIES["orders_incremental_pull"](spark, SMALL))
    assert "GreaterThanOrEqual(updated_at" in text and "LessThan(updated_at" in text
