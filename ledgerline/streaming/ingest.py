"""File drops judged and reconciled as they land, with Structured Streaming."""

from __future__ import annotations

import datetime as dt
import re
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators import contract as rules
from ledgerline.plans import forward
from ledgerline.schemas import CONTRACTS
from ledgerline.session import materialize, together
from ledgerline.sources.csv_files import read_drop
from ledgerline.sources.tables import Tables

FILES_A_BATCH = 100
_DAY = re.compile(r"(\d{4}-\d{2}-\d{2})/[^/]*$")


def store_drop(tables: Tables, path: str, source: str, run_date: dt.date, now: dt.datetime) -> None:
    """Judge one day's file of a source by the rules of the daily load and replace that day's rows by it."""
    contract = CONTRACTS[source]
    rows = read_drop(tables.spark, path, contract).withColumn("run_date", F.lit(run_date))
    checked = materialize(rules.with_reason(rows, contract), f"checked-{source}")
    dead = rules.rejects(checked, contract).withColumn("rejected_at", F.lit(now))
    tables.replace_partition("raw/rejected", dead, run_date=run_date, source=source)
    good = rules.typed(rules.valid(checked), contract).withColumn("ingested_at", F.lit(now))
    tables.replace_day(forward.RAW[source], good, run_date)


def refresh_days(tables: Tables, days: list[dt.date]) -> None:
    """Bring the kept tables forward by the loads of ``days``; build them if they are not there yet."""
    if forward.is_kept(tables):
        for day in days:
            forward.advance(tables, day)
    else:
        forward.rebuild(tables)


def ingest_new_files(
    spark: SparkSession, landing: str, tables: Tables, source: str, checkpoint: str,
) -> StreamingQuery:
    """Load the files of one source that have not been seen, bring the fact forward, then stop.

    Files lie in folders named by day, ``<landing>/<run_date>/<source>.csv``. The stream only
    says which files are new; they are read by the batch reader, so columns go by each file's
    header and what the daily load rejects is rejected here. A file replaces the rows of its day
    and source, and the orders it touches are computed anew, so a micro-batch repeated after a
    failure has the same outcome. There is no watermark: late rows are a matter of the keyed
    replace, which keeps orders open for as long as something arrives for them.
    """
    names = (
        spark.readStream.format("text").option("maxFilesPerTrigger", FILES_A_BATCH)
        .load(f"{landing}/*/{source}.csv").select(F.col("_metadata.file_path").alias("path"))
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        # At most FILES_A_BATCH names.
        found = sorted(row.path for row in batch.distinct().collect())
        days = {path: dt.date.fromisoformat(_DAY.search(path)[1]) for path in found}
        now = dt.datetime.now(dt.timezone.utc)
        if not days:
            return
        # The files of a micro-batch and what they change become visible together.
        with tables.commit():
            together(*[partial(store_drop, tables, path, source, day, now) for path, day in days.items()])
            refresh_days(tables, sorted(set(days.values())))

    return (
        names.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
