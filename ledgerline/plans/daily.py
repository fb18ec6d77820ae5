"""One day from sources to marts, and a range of days in order."""

from __future__ import annotations

import datetime as dt
import time
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import contract as rules
from ledgerline.operators import deltas, dimensions, quality
from ledgerline.plans import forward
from ledgerline.plans.forward import FACT, PAYMENTS, RAW
from ledgerline.schemas import ANSWER_KEY, CONTRACTS, RUN_LOG
from ledgerline.session import materialize, prepare, release, together
from ledgerline.sources.csv_files import read_drop, read_seed
from ledgerline.sources.extract import as_text, orders_incremental_pull
from ledgerline.sources.tables import BUCKETS, Tables


def run_log(
    spark: SparkSession, run_date: dt.date, step: str, rows_in: int, rows_out: int, rows_rejected: int,
    seconds: float, now: dt.datetime,
) -> DataFrame:
    """One run-log row."""
    row = Row(
        rows_in=rows_in, rows_out=rows_out, rows_rejected=rows_rejected, seconds=seconds,
        created_at=now, run_date=run_date, step=step,
    )
    return spark.createDataFrame([row]).select(
        "rows_in", "rows_out", "rows_rejected",
        F.col("seconds").cast(RUN_LOG["duration_seconds"].dataType).alias("duration_seconds"),
        "created_at", "run_date", "step",
    )


class _Log:
    def __init__(self, tables: Tables, run_date: dt.date, now: dt.datetime):
        self.tables, self.run_date, self.now = tables, run_date, now
        self.started = time.monotonic()

    def step(self, name: str, rows_in: int, rows_out: int, rows_rejected: int = 0) -> None:
        taken = time.monotonic() - self.started
        row = run_log(
            self.tables.spark, self.run_date, name, rows_in, rows_out, rows_rejected, taken, self.now
        )
        self.tables.append("raw/pipeline_runs", row)
        self.started = time.monotonic()


def ingest_day(tables: Tables, run_date: dt.date, landing: str, now: dt.datetime) -> None:
    """Extract, validate and load one day; repeating it replaces what it wrote.

    Every source is read once: the judged rows are stored, and both the bronze rows
    and the dead letters come from that copy.
    """
    spark = tables.spark
    log = _Log(tables, run_date, now)
    sources = {
        "orders": as_text(orders_incremental_pull(tables.read("app/orders"), run_date)),
        "gateway": read_drop(spark, f"{landing}/{run_date}/gateway.csv", CONTRACTS["gateway"]),
        "settlement": read_drop(spark, f"{landing}/{run_date}/settlement.csv", CONTRACTS["settlement"]),
    }
    def judge(name: str) -> tuple[DataFrame, Row]:
        rows = sources[name].withColumn("run_date", F.lit(run_date))
        stored = materialize(rules.with_reason(rows, CONTRACTS[name]), f"checked-{name}")
        return stored, rules.counts(stored).first()

    judged = dict(zip(sources, together(*[partial(judge, name) for name in sources])))
    totals = [total for _, total in judged.values()]
    seen = sum(t.rows_in for t in totals)
    passed = sum(t.rows_out for t in totals)
    log.step("extract", seen, seen)

    def reject(name: str) -> None:
        dead = rules.rejects(judged[name][0], CONTRACTS[name]).withColumn("rejected_at", F.lit(now))
        tables.replace_partition("raw/rejected", dead, run_date=run_date, source=name)

    together(*[partial(reject, name) for name in sources])
    log.step("validate", seen, passed, seen - passed)

    def load(name: str) -> None:
        good = rules.typed(rules.valid(judged[name][0]), CONTRACTS[name])
        tables.replace_day(RAW[name], good.withColumn("ingested_at", F.lit(now)), run_date)

    together(*[partial(load, name) for name in sources])
    log.step("load", passed, passed)


def snapshot_merchants(tables: Tables, run_date: dt.date) -> DataFrame:
    """Next state of the merchant history, kept as one folder per run day.

    The history is not written over while it is read, and repeating a day starts again
    from the day before it.
    """
    name = "staging/merchants_snapshot"
    earlier = tables.read(name).where(F.col("as_of") < F.lit(run_date))
    last = earlier.agg(F.max("as_of").alias("last")).first().last
    previous = earlier.where(F.col("as_of") == F.lit(last)).drop("as_of")
    merged = dimensions.scd2_merge(previous, tables.read("app/merchants"), "merchant_id", "updated_at")
    tables.replace_partition(name, merged, as_of=run_date)
    return tables.read(name).where(F.col("as_of") == F.lit(run_date)).drop("as_of")


def _write_marts(tables: Tables, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    written = together(*[partial(tables.overwrite, f"marts/{name}", df) for name, df in frames.items()])
    return dict(zip(frames, written))


def bring_forward(tables: Tables, run_date: dt.date, full_refresh: bool = False) -> None:
    """Staging, facts and sums with the loads of ``run_date``; built anew on request and on the first day."""
    if full_refresh or not forward.is_kept(tables):
        forward.rebuild(tables)
    else:
        forward.advance(tables, run_date)
    forward.restore_sums(tables)


def build_marts(tables: Tables, run_date: dt.date, full_refresh: bool = False) -> dict[str, DataFrame]:
    """Snapshot, staging, facts and summaries; returns every table by name."""
    spark = tables.spark
    bring_forward(tables, run_date, full_refresh)
    log = tables.read("raw/pipeline_runs")
    dims = {
        "dim_merchants": dimensions.dim_merchants(snapshot_merchants(tables, run_date)),
        "dim_date": dimensions.dim_date(spark),
    }
    out = _write_marts(tables, dims)
    out |= _write_marts(tables, {
        "daily_reconciliation_summary": deltas.daily_from(tables.read("sums/days"), log),
        "merchant_discrepancy_summary": deltas.merchants_from(tables.read("sums/merchants"), out["dim_merchants"]),
        "accuracy_by_error_type": deltas.accuracy_from(tables.read("sums/detectors"), log),
    })
    staged = forward.staged(tables)
    return out | {
        "stg_orders": staged["orders"], "stg_gateway_events": staged["gateway"], "stg_settlements": staged["settlement"],
        "fact_reconciliation": tables.read(FACT), "fact_payments": tables.read(PAYMENTS), "run_log": log,
        "answer_key": tables.read("staging/answer_key"),
        "raw_orders": tables.read(RAW["orders"]), "raw_gateway": tables.read(RAW["gateway"]),
        "raw_settlements": tables.read(RAW["settlement"]),
    }


def run_day(
    spark: SparkSession, root: str, run_date: dt.date, landing: str | None = None,
    full_refresh: bool = False, now: dt.datetime | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """Process one day under ``root`` and return its quality report. The first day makes the keyed
    tables with so many ``buckets``.

    All tables change in one commit: readers see the day in all of them or in none, and a day
    that breaks off can be run again. Raises ``QualityError`` after the commit if a check of severity
    error fails. Days run one at a time; of two runs at once the one that ends last fails with
    ``Conflict``. The temporary tables of the application are deleted at the end, and files that no
    reader has needed for a week.
    """
    prepare(spark)
    tables = Tables(spark, root, buckets)
    try:
        with tables.commit():
            ingest_day(tables, run_date, landing or tables.path("data"), now or dt.datetime.now(dt.timezone.utc))
            built = build_marts(tables, run_date, full_refresh)
            tables.replace_day("marts/quality_report", quality.run_checks(built).coalesce(1), run_date)
        tables.vacuum()
    finally:
        release(spark)
    report = tables.read("marts/quality_report", parts=[str(run_date)])
    quality.raise_on_errors(report)
    return report


def backfill(spark: SparkSession, root: str, start: dt.date, end: dt.date, **options) -> None:
    """Run every day from ``start`` to ``end`` in order; the first failing day stops it."""
    for offset in range((end - start).days + 1):
        run_day(spark, root, start + dt.timedelta(days=offset), **options)


def load_answer_key(spark: SparkSession, root: str, csv_path: str) -> None:
    """Replace the labelled results that the detectors are scored against."""
    tables = Tables(spark, root)
    with tables.commit():
        tables.overwrite("staging/answer_key", read_seed(spark, csv_path, ANSWER_KEY))
        tables.drop("sums/detectors")


# Marts a SQL user reads, besides the staging views.
MARTS = (
    "fact_reconciliation", "fact_payments", "dim_merchants", "dim_date",
    "daily_reconciliation_summary", "merchant_discrepancy_summary", "accuracy_by_error_type", "quality_report",
)


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Make the tables under ``root`` available to Spark SQL by name; returns the names.

    All views are of one version of the tables, which stays readable for a week after it
    was replaced; register again to see the days since.
    """
    prepare(spark)
    tables = Tables(spark, root)
    with tables.commit():
        frames = {name: tables.read(f"marts/{name}") for name in MARTS}
        frames |= dict(zip(("stg_orders", "stg_gateway_events", "stg_settlements"), forward.staged(tables).values()))
        frames |= {
            "raw_orders": tables.read("raw/orders"),
            "raw_gateway_events": tables.read("raw/gateway_events"),
            "raw_settlements": tables.read("raw/settlements"),
            "rejected": tables.read("raw/rejected"),
            "pipeline_runs": tables.read("raw/pipeline_runs"),
            "answer_key": tables.read("staging/answer_key"),
        }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
