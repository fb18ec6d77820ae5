from pyspark.sql import functions as F

from conftest import SMALL, day, same
from ledgerline.operators import contract, reconcile, staging
from ledgerline.plans import fixtures, forward
from ledgerline.plans.catalogue import Inputs
from ledgerline.schemas import CONTRACTS
from ledgerline.sources.csv_files import read_drop
from ledgerline.sources.tables import Tables
from ledgerline.streaming.ingest import ingest_new_files

NAMES = CONTRACTS["gateway"].required


def land(root, d, *lines, header=NAMES):
    folder = root / "landing" / str(day(d))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "gateway.csv").write_text(",".join(header) + "\n" + "".join(line + "\n" for line in lines))


def run(spark, root, source="gateway"):
    tables = Tables(spark, str(root / "out"))
    ingest_new_files(spark, str(root / "landing"), tables, source, str(root / f"state-{source}")).awaitTermination()
    return tables


def test_files_are_judged_by_the_rules_of_the_batch(spark, tmp_path):
    land(
        tmp_path, 1, "T1,O1,success,5.00,2026-09-01T00:00:00,payment", ",O2,success,5.00,2026-09-01,payment",
        "T2,O2,success,5.00,2026-09-01,payment,more,cells", 'T4,O4,success,1,2026-09-01,"two', 'lines"', 'T5,O5,success,1,2026-09-01,"open',
    )
    run(spark, tmp_path)
    # Another order of columns, and a later file of a day that was already loaded.
    land(tmp_path, 2, "payment,O3,T3,7.00,failed,2026-09-02T00:00:00", header=["event_type", "order_id", "txn_id", "amount", "gateway_status", "event_time"])
    run(spark, tmp_path)
    tables = run(spark, tmp_path)
    good = tables.read("raw/gateway_events")
    assert sorted((r.txn_id, r.run_date, str(r.amount), r.event_type) for r in good.collect()) == [
        ("T1", day(1), "5.00", "payment"), ("T3", day(2), "7.00", "payment"), ("T4", day(1), "1.00", "two\nlines"),
    ]
    bad = tables.read("raw/rejected").where(F.col("source") == "gateway")
    batch = read_drop(spark, str(tmp_path / "landing" / str(day(1)) / "gateway.csv"), CONTRACTS["gateway"])
    checked = contract.with_reason(batch, CONTRACTS["gateway"]).where("reason is not null")
    assert sorted(r.reason for r in bad.collect()) == sorted(r.reason for r in checked.collect()) == [
        "missing required field: txn_id", "more cells than header fields", "quote is never closed",
    ]


def test_the_streamed_fact_is_the_batch_fact(spark, tmp_path):
    i = Inputs(spark, SMALL)
    tables = Tables(spark, str(tmp_path / "out"))
    tables.load_days("raw/orders", i.raw_orders)
    kept = {"gateway": (i.raw_gateway, "gateway"), "settlement": (i.raw_settlements, "settlement")}
    until = F.lit(fixtures.day(3))
    for days in ([0, 1, 2], [3]):
        for source, (raw, name) in kept.items():
            for offset in days:
                folder = tmp_path / "landing" / str(fixtures.day(offset))
                folder.mkdir(parents=True, exist_ok=True)
                rows = raw.where(F.col("run_date") == F.lit(fixtures.day(offset))).select(
                    *[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if t == "timestamp" else F.col(c).cast("string").alias(c)
                      for c, t in raw.dtypes if c in CONTRACTS[source].required]
                ).toPandas()
                rows.to_csv(folder / f"{name}.csv", index=False)
            run(spark, tmp_path, source)
    upto = F.col("run_date") <= until
    full = reconcile.reconcile(
        staging.stg_orders(i.raw_orders),
        staging.stg_gateway_events(i.raw_gateway.where(upto)), staging.stg_settlements(i.raw_settlements.where(upto)), i.hot_orders,
    )
    got = tables.read(forward.FACT).select(*reconcile.FACT_COLS)
    assert got.count() > 1000 and same(got, full)
