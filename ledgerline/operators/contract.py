"""Row contracts as column expressions: the first rule a row breaks is its reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import is_below_zero, parse_money, parse_time, quoted
from ledgerline.schemas import Contract

# Set by the file reader on rows that it could not read as the header has it.
MALFORMED = "_malformed"
SURPLUS = "more cells than header fields"
UNCLOSED = "quote is never closed"


def _message(text: str, shown: Column) -> Column:
    return F.concat(F.lit(text), shown)


def _rules(contract: Contract) -> list[tuple[Column, Column]]:
    """(broken, reason) pairs in the order they are checked."""
    c = F.col
    rules = [
        (c(name).isNull() | (c(name) == ""), F.lit(f"missing required field: {name}"))
        for name in contract.required
    ]
    for name in contract.numeric:
        rules.append((parse_money(c(name)).isNull(), _message(f"non-numeric value for {name}: ", quoted(c(name)))))
        negative = is_below_zero(c(name))
        if name in contract.signed_on_refund:
            negative = negative & (c("settlement_type") != "refund")
        rules.append((negative, _message(f"negative value for {name}: ", c(name))))
    for name in contract.timestamps:
        rules.append(
            (parse_time(c(name)).isNull(), _message(f"unparseable timestamp for {name}: ", quoted(c(name))))
        )
    for name, values in contract.allowed.items():
        rules.append((~c(name).isin(*values), _message(f"unexpected value for {name}: ", quoted(c(name)))))
    return rules


def with_reason(df: DataFrame, contract: Contract) -> DataFrame:
    """Add ``reason``: NULL for a valid row, else the first rule it breaks.

    A column the source lacks counts as missing in every row.
    """
    absent = [name for name in contract.required if name not in df.columns]
    df = df.withColumns({name: F.lit(None).cast("string") for name in absent}) if absent else df
    checks = [F.when(broken, message) for broken, message in _rules(contract)]
    if MALFORMED in df.columns:
        # Cells of a row with an open quote mean nothing; otherwise the fields are judged first.
        checks = [F.when(F.col(MALFORMED) == UNCLOSED, UNCLOSED), *checks, F.col(MALFORMED)]
    return df.withColumn("reason", F.coalesce(*checks))


def _row_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("reason", "run_date", MALFORMED)]


def rejects(checked: DataFrame, contract: Contract) -> DataFrame:
    """Dead letters out of ``with_reason`` rows: the whole row as JSON and why it failed."""
    row = F.to_json(F.struct(*_row_columns(checked)), {"ignoreNullFields": "false"})
    return checked.where(F.col("reason").isNotNull()).select(
        F.lit(contract.source).alias("source"), row.alias("row_data"), "reason", "run_date",
    )


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).drop("reason", MALFORMED)


def split(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, dead letters). Materialize ``with_reason`` first to scan the source once."""
    checked = with_reason(df, contract)
    return valid(checked), rejects(checked, contract)


def typed(valid_rows: DataFrame, contract: Contract) -> DataFrame:
    """Valid text rows in the table's types; columns outside the contract are dropped."""

    def convert(name: str, kind: T.DataType) -> Column:
        text = F.col(name)
        if name in contract.numeric:
            return parse_money(text)
        if name in contract.timestamps:
            # A date column takes the date as written, whatever offset follows it.
            return parse_time(text) if kind == T.TimestampType() else F.substring(text, 1, 10).cast(kind)
        return text

    kept = [convert(f.name, f.dataType).alias(f.name) for f in contract.schema.fields]
    return valid_rows.select(*kept, *[c for c in ("run_date",) if c in valid_rows.columns])


def counts(checked: DataFrame) -> DataFrame:
    """One row: rows in, rows passed on, rows rejected."""
    return checked.agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.col("reason").isNull()).alias("rows_out"),
        F.count_if(F.col("reason").isNotNull()).alias("rows_rejected"),
    )


def by_reason(dead_letters: DataFrame) -> DataFrame:
    """Reject counts per source and kind of failure, the offending value left out."""
    kind = F.substring_index("reason", ": ", 1)
    field = F.when(F.col("reason").startswith("missing required field"), F.col("reason")).otherwise(kind)
    return dead_letters.groupBy("source", field.alias("kind")).agg(F.count("*").alias("rejected"))


def run_log_by_day(checked: list[DataFrame]) -> DataFrame:
    """Run-log rows (run_date, step, rows in, out, rejected) for days already judged."""
    per_day = reduce(
        DataFrame.unionByName, [rows.select("run_date", F.col("reason").isNull().alias("ok")) for rows in checked]
    ).groupBy("run_date").agg(F.count("*").alias("seen"), F.count_if("ok").alias("passed"))
    seen, passed, none = F.col("seen"), F.col("passed"), F.lit(0).cast("long")

    def step(name: str, rows_in: Column, rows_out: Column, rejected: Column) -> Column:
        return F.struct(
            F.lit(name).alias("step"), rows_in.alias("rows_in"), rows_out.alias("rows_out"),
            rejected.alias("rows_rejected"),
        )

    steps = F.array(
        step("extract", seen, seen, none),
        step("validate", seen, passed, seen - passed),
        step("load", passed, passed, none),
    )
    return per_day.select("run_date", F.inline(steps))
