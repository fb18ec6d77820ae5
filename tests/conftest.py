import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerline.session import prepare  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


def day(n: int) -> dt.date:
    return dt.date(2026, 9, n)


def at(n: int, hour: int = 0, minute: int = 0) -> dt.datetime:
    return dt.datetime(2026, 9, n, hour, minute, tzinfo=dt.timezone.utc)


def by(df, *keys):
    """Rows as dicts, in a fixed order."""
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: [repr(r[k]) for k in keys])


def same(left, right) -> bool:
    """Whether two frames hold the same rows, repeats included."""
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
