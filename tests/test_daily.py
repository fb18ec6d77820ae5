import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, at, day, same
from ledgerline.operators import reconcile as rec
from ledgerline.operators import staging
from ledgerline.operators.quality import QualityError
from ledgerline.plans import daily, fixtures
from ledgerline.plans.catalogue import Inputs
from ledgerline.plans.fixtures import answer_key
from ledgerline.schemas import CONTRACTS
from ledgerline.sources.csv_files import write_seed
from ledgerline.sources.extract import as_text
from ledgerline.sources.tables import Tables

DAYS = [fixtures.day(n) for n in range(3)]


def write_drop(rows, folder, name):
    """One CSV file with a header, as the other systems deliver it."""
    folder.mkdir(parents=True, exist_ok=True)
    rows.toPandas().to_csv(folder / f"{name}.csv", index=False)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Three days of sources: application tables as Parquet, gateway and settlements as CSV."""
    root = tmp_path_factory.mktemp("company")
    i = Inputs(spark, SMALL)
    text = {
        "gateway": as_text(i.raw_gateway.drop("ingested_at")),
        "settlement": as_text(i.raw_settlements.drop("ingested_at")),
    }
    for name, rows in text.items():
        for d in DAYS:
            today = rows.where(F.col("run_date") == str(d)).select(*CONTRACTS[name].required)
            write_drop(today, root / "data" / str(d), name)
    broken = i.stored(fixtures.staged_gateway).where((F.col("run_date") == F.lit(DAYS[1])) & (F.col("txn_id") == ""))
    with open(root / "data" / str(DAYS[1]) / "gateway.csv", "a") as f:
        for r in broken.select(*CONTRACTS["gateway"].required).collect():
            f.write(",".join(r) + "\n")
    write_seed(answer_key(i.stored(fixtures.truth)), str(root / "seed"))
    daily.load_answer_key(spark, str(root), str(root / "seed"))
    return root


def company_works(spark, root, d):
    """What the application does on day ``d``: new and changed orders, new fee rates."""
    i, tables = Inputs(spark, SMALL), Tables(spark, str(root))
    orders = i.raw_orders.where(F.col("run_date") == F.lit(d)).select(*CONTRACTS["orders"].required)
    # Stale values outside the updated columns must not come through.
    changed = orders.withColumn(
        "customer_vpa", F.when(F.col("updated_at") > F.col("created_at"), "stale").otherwise(F.col("customer_vpa"))
    )
    tables.upsert("app/orders", changed, "order_id", ["status", "updated_at"])
    states = i.merchant_history.where(F.to_date("updated_at") == F.lit(d))
    tables.upsert("app/merchants", states, "merchant_id", ["fee_rate", "updated_at"])


def rebuilt(tables):
    return rec.reconcile(
        staging.stg_orders(tables.read("raw/orders")),
        staging.stg_gateway_events(tables.read("raw/gateway_events")),
        staging.stg_settlements(tables.read("raw/settlements")),
    )


def fact_of(spark, tables):
    return tables.read(daily.FACT).select(*rec.FACT_COLS)


def test_days_in_order(spark, root):
    tables = Tables(spark, str(root))
    for n, d in enumerate(DAYS):
        company_works(spark, root, d)
        report = daily.run_day(spark, str(root), d, now=at(d.day + 1))
        assert report.count() == 38
        fact = fact_of(spark, tables)
        assert same(fact, rebuilt(tables)), d
    i = Inputs(spark, SMALL)
    upto = F.col("run_date") <= F.lit(DAYS[-1])
    for raw, name in ((i.raw_orders, "raw/orders"), (i.raw_gateway, "raw/gateway_events"),
                      (i.raw_settlements, "raw/settlements")):
        expected = raw.where(upto).drop("ingested_at")
        assert same(tables.read(name).drop("ingested_at"), expected), name

    log = tables.read("raw/pipeline_runs")
    assert {(r.run_date, r.step) for r in log.collect()} == {
        (d, s) for d in DAYS for s in ("extract", "validate", "load")
    }
    rejected = tables.read("raw/rejected")
    assert rejected.count() == log.where("step = 'validate'").agg(F.sum("rows_rejected")).first()[0] > 0
    assert {r.run_date for r in rejected.collect()} == {DAYS[1]}

    snapshot = tables.read("staging/merchants_snapshot").where(F.col("as_of") == F.lit(DAYS[-1]))
    expected = i.merchant_history.where(F.to_date("updated_at") <= F.lit(DAYS[-1]))
    assert snapshot.count() == expected.count()
    assert snapshot.where("valid_to is null").count() == 10
    assert tables.read("marts/accuracy_by_error_type").count() == 5


def test_tables_answer_sql(spark, root):
    names = daily.register_views(spark, str(root))
    assert len(names) == 17
    totals = spark.sql(
        "select reconciliation_status, count(*) n from fact_reconciliation group by 1"
    ).collect()
    assert sum(r.n for r in totals) == spark.table("stg_orders").count() + spark.sql(
        "select 1 from fact_reconciliation where is_orphan_payment"
    ).count()
    assert spark.sql(
        "select count(*) n from fact_payments p join dim_merchants m using (merchant_id) where m.is_current"
    ).first().n > 0


def test_repeating_a_day_changes_nothing(spark, root):
    tables = Tables(spark, str(root))
    names = ["raw/orders", "raw/gateway_events", "raw/settlements", "raw/rejected", "staging/merchants_snapshot"]
    before = {n: tables.read(n).drop("ingested_at", "rejected_at").toPandas() for n in names}
    fact = fact_of(spark, tables).toPandas()
    daily.run_day(spark, str(root), DAYS[-1], now=at(9))
    for n in names:
        after = tables.read(n).drop("ingested_at", "rejected_at").toPandas()
        order = list(after.columns)
        left, right = (
            f.astype(str).sort_values(order).reset_index(drop=True) for f in (before[n], after[order])
        )
        assert left[order].equals(right), n
    after = fact_of(spark, tables).toPandas()
    cols = list(after.columns)
    assert fact.astype(str).sort_values(cols).reset_index(drop=True).equals(
        after.astype(str).sort_values(cols).reset_index(drop=True)
    )


def test_missing_drop_empties_the_day_and_full_refresh_follows(spark, root, tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(root, copy)
    (copy / "data" / str(DAYS[2]) / "settlement.csv").unlink()
    tables = Tables(spark, str(copy))
    assert tables.read("raw/settlements").where(F.col("run_date") == F.lit(DAYS[2])).count() > 0
    daily.run_day(spark, str(copy), DAYS[2], full_refresh=True, now=at(9))
    assert tables.read("raw/settlements").where(F.col("run_date") == F.lit(DAYS[2])).count() == 0
    assert same(fact_of(spark, tables), rebuilt(tables))


class Broken(Exception):
    pass


def breaking(*_, **__):
    raise Broken


def rows_of(tables):
    names = [*daily.RAW.values(), daily.FACT, daily.PAYMENTS, "sums/days", "marts/daily_reconciliation_summary", "raw/pipeline_runs"]
    return {n: sorted(map(repr, tables.read(n).collect())) for n in names}


@pytest.mark.parametrize("place", ["ledgerline.operators.deltas.add", "ledgerline.operators.quality.run_checks"])
def test_a_day_that_breaks_off_is_in_no_table(spark, root, tmp_path, monkeypatch, place):
    copy = tmp_path / "copy"
    shutil.copytree(root, copy)
    (copy / "data" / str(DAYS[2]) / "settlement.csv").unlink()
    tables = Tables(spark, str(copy))
    before = rows_of(tables)
    with monkeypatch.context() as m:
        m.setattr(place, breaking)
        with pytest.raises(Broken):
            daily.run_day(spark, str(copy), DAYS[-1], now=at(9))
    assert rows_of(tables) == before
    daily.run_day(spark, str(copy), DAYS[-1], now=at(9))
    assert rows_of(tables) != before and same(fact_of(spark, tables), rebuilt(tables))


def test_failed_check_stops_the_run_after_the_report(spark, root, tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(root, copy)
    key = Tables(spark, str(root)).read("staging/answer_key")
    Tables(spark, str(copy)).overwrite("staging/answer_key", key.withColumn("expected_result", F.lit("bogus")))
    with pytest.raises(QualityError, match="accepted_values.answer_key.expected_result"):
        daily.backfill(spark, str(copy), DAYS[2], DAYS[2], now=at(9))
    assert Tables(spark, str(copy)).read("marts/quality_report").where(
        F.col("run_date") == F.lit(DAYS[2])
    ).count() == 38


def test_replacing_a_day_by_nothing(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    rows = spark.sql("select 'a' k, date'2026-09-01' run_date union all select 'b', date'2026-09-02'")
    for d in (1, 2):
        tables.replace_day("t", rows.where(F.col("run_date") == F.lit(day(d))), day(d))
    tables.replace_day("t", rows.limit(0), day(1))
    assert [tuple(r) for r in tables.read("t", rows.schema).collect()] == [("b", day(2))]
    assert tables.exists("t") and not tables.exists("u")


def test_missing_orders_are_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Tables(spark, str(tmp_path / "typo")).read("app/orders")


def test_views_outlive_later_versions(spark, root, tmp_path):
    """A view registered before two more days still reads the rows it was registered on."""
    copy = tmp_path / "copy"
    shutil.copytree(root, copy)
    daily.register_views(spark, str(copy))
    before = spark.sql("select count(*) from daily_reconciliation_summary").first()[0]
    tables = Tables(spark, str(copy))
    for _ in range(3):
        tables.overwrite("marts/daily_reconciliation_summary", tables.read("marts/daily_reconciliation_summary").limit(1))
        tables.vacuum()
    assert spark.sql("select count(*) from daily_reconciliation_summary").first()[0] == before
    daily.register_views(spark, str(copy))
    assert spark.sql("select count(*) from daily_reconciliation_summary").first()[0] == 1
