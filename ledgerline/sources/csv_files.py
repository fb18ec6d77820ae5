"""Daily CSV drops, read as text for the contract to judge."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.contract import MALFORMED, SURPLUS, UNCLOSED
from ledgerline.schemas import Contract
from ledgerline.session import is_missing

_RAW_LINE = "_raw_line"
# Lines of one record; beyond, its quote counts as never closed.
MOST_LINES = 10_000
# A whole quoted cell, whose commas do not separate; the start of one that stays open; the end of one.
_QUOTED = r'"(?:[^"]|"")*+"'
_CELL = rf"(^|,){_QUOTED}"
_OPENS = r'(^|,)"'
_CLOSES = r'^(?:[^"]|"")*+"'


def _empty(spark: SparkSession, names: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
    return spark.createDataFrame([], schema)


def _open_after(text: Column) -> Column:
    """Whether a line that starts outside quotes ends inside them. Quotes inside a plain cell do not count."""
    return F.regexp_replace(text, _CELL, "$1").rlike(_OPENS)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, split and place, and how each carries the state of being inside
    quotes on: the state after it if it starts outside (``out``) and inside (``inn``)."""
    rest = F.regexp_replace("value", _CLOSES, "")
    closed = F.col("value").rlike(_CLOSES)
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
    ).withColumns({"out": _open_after(F.col("value")), "inn": ~closed | _open_after(rest)})


def _carried(df: DataFrame, keys: list[str], order: str, start: Column) -> DataFrame:
    """Add ``inside``, the state before each row, from the rows' ``out`` and ``inn`` in order.

    A row passes the state on, turns it round, or sets it. The state is what the last row that
    sets it left, turned round as often as rows did since; ``start`` before any.
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col("out") == F.col("inn")
    turns = F.coalesce(F.sum((F.col("out") & ~F.col("inn")).cast("int")).over(before), F.lit(0))
    turned = df.withColumn("_turns", turns)
    last = F.last(F.when(sets, F.struct(F.col("out").alias("state"), F.col("_turns").alias("turns"))), True).over(before)
    state = F.coalesce("_last.state", start) != ((F.col("_turns") - F.coalesce("_last.turns", F.lit(0))) % 2 == 1)
    return turned.withColumn("_last", last).withColumn("inside", state).drop("_turns", "_last")


def _with_state(lines: DataFrame) -> DataFrame:
    """Add ``inside``: splits are scanned each by itself, then their states are carried along the file."""
    from_outside = _carried(lines, ["file", "split"], "at", F.lit(False))
    from_inside = _carried(lines, ["file", "split"], "at", F.lit(True))

    def after(df: DataFrame, name: str) -> DataFrame:
        end = F.when(F.col("inside"), F.col("inn")).otherwise(F.col("out"))
        return df.groupBy("file", "split").agg(F.max_by(end, "at").alias(name))

    splits = after(from_outside, "out").join(after(from_inside, "inn"), ["file", "split"])
    starts = _carried(splits, ["file"], "split", F.lit(False)).select("file", "split", F.col("inside").alias("_start"))
    started = lines.join(starts, ["file", "split"])
    return _carried(started, ["file", "split"], "at", F.col("_start")).drop("_start")


def _named(parts: DataFrame) -> DataFrame:
    """Lines of records that span lines, with ``record``, the place of the record's first line: found
    in a line's own split, else the last one of the splits before it."""
    opens = F.when(~F.col("inside"), F.col("at"))
    in_split = Window.partitionBy("file", "split").orderBy("at")
    along = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    # One row per split.
    splits = parts.groupBy("file", "split").agg(F.max(opens).alias("opened"))
    carried = splits.select("file", "split", F.last("opened", True).over(along).alias("earlier"))
    own = parts.withColumn("own", F.last(opens, True).over(in_split))
    return own.join(carried, ["file", "split"]).withColumn("record", F.coalesce("own", "earlier")).drop("own", "earlier")


def _records(lines: DataFrame, most: int = MOST_LINES) -> DataFrame:
    """(file, value, unclosed): records, those of several lines put together.

    If a file ends inside quotes, the line that opens them is reported and what follows it is
    taken line by line, so one stray quote does not swallow the rest; such lines are found by one
    place per file and never gathered. A record of more than ``most`` lines is treated alike.
    """
    stated = _with_state(lines).withColumn("after", F.when(F.col("inside"), F.col("inn")).otherwise(F.col("out")))
    place = F.struct("split", "at")
    ends = stated.groupBy("file").agg(F.max_by("after", place).alias("torn"), F.max(F.when(~F.col("inside"), place)).alias("opener"))
    # One row per file, as in the file listing.
    stated = stated.join(F.broadcast(ends), "file").withColumn("lost", F.col("torn") & (place >= F.col("opener")))
    alone = stated.where("NOT lost AND NOT inside AND NOT after").select("file", "value", F.lit(False).alias("unclosed"))
    torn = stated.where("lost").select("file", "value", (place == F.col("opener")).alias("unclosed"))
    named = _named(stated.where("NOT lost AND (inside OR after)").drop("torn", "opener", "lost"))
    sizes = named.groupBy("file", "record").agg((F.count("*") > most).alias("long"))
    named = named.join(sizes, ["file", "record"])
    # At most ``most`` lines each.
    grouped = named.where("NOT long").groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("split", "at", "value"))).alias("lines"))
    whole = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    closed = grouped.select("file", whole.alias("value"), F.lit(False).alias("unclosed"))
    endless = named.where("long").select("file", "value", (F.col("at") == F.col("record")).alias("unclosed"))
    return alone.unionByName(torn).unionByName(closed).unionByName(endless)


def read_drop(spark: SparkSession, path: str | list[str], contract: Contract) -> DataFrame:
    """All-text rows of a CSV file, a folder, or several of them.

    Columns go by the names of each file's own header, in whatever order it lists them. Short
    rows are filled with NULL; rows with surplus cells and rows whose quotes never close are
    marked. A missing or empty file gives no rows under the contract's column names. Files are
    split over tasks, also where records run over several lines.
    """
    try:
        lines = _lines(spark, path)
    except AnalysisException as err:
        if not is_missing(err):
            raise
        return _empty(spark, contract.required)
    # One row per file, as in the file listing; a header is one line.
    place = F.struct("split", "at")
    first = lines.where("value <> ''").groupBy("file").agg(F.min_by("value", place).alias("header"), F.min(place).alias("f"))
    # As long as the file listing, which the driver holds anyway.
    first = F.broadcast(first.select("file", "header", "f.at"))
    headers = [row.header for row in first.select("header").distinct().collect()]
    if not headers:
        return _empty(spark, contract.required)
    body = lines.join(first.select("file", "at"), ["file", "at"], "left_anti")
    if body.where("out").isEmpty():
        # No line leaves a quote open, so every line is a record.
        rows = body.select("file", "value", F.lit(False).alias("unclosed"))
    else:
        rows = _records(body)
    rows = rows.where("value <> ''")
    if len(headers) > 1:
        rows = rows.join(first.select("file", "header"), "file")
    found = [
        _parsed(rows if len(headers) == 1 else rows.where(F.col("header") == header), header) for header in sorted(headers)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def _parsed(rows: DataFrame, header: str) -> DataFrame:
    names = next(csv.reader([header]))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW_LINE]])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW_LINE, "multiLine": "true"}
    cells = rows.select("value", "unclosed", F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), options).alias("cells"))
    # The parser sets the raw line on rows of the wrong length, long or short.
    commas = F.regexp_count(F.regexp_replace("value", _QUOTED, ""), F.lit(","))
    surplus = F.col("cells")[_RAW_LINE].isNotNull() & (commas >= len(names))
    marked = F.when(F.col("unclosed"), UNCLOSED).when(surplus, SURPLUS)
    return cells.select(*[F.col("cells")[n].alias(n) for n in names], marked.alias(MALFORMED))


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A typed seed table; a file with only a header gives no rows."""
    return spark.read.schema(schema).csv(path, header=True, escape='"')


def write_seed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')
