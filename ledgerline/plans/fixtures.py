"""Payment tables derived from the order and supplier tables.

Each order row fans out into its loads, gateway events and settlements by integer
arithmetic on its key, inside one narrow projection: no join, one scan of the orders
per derived table. The only other input is the number of suppliers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.money import fee_split

# First day, last loaded day, and a category per nation remainder.
DAY0 = dt.date(2026, 9, 1)
LAST_DAY = 9
CATEGORIES = ["bakery", "hardware", "travel", "books"]
_EPOCH_DAY0 = int(dt.datetime(2026, 9, 1, tzinfo=dt.timezone.utc).timestamp())


def day(offset: int) -> dt.date:
    return DAY0 + dt.timedelta(days=offset)


def _date(offset: Column) -> Column:
    return F.date_add(F.lit(DAY0), offset.cast("int"))


def _instant(days: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.lit(_EPOCH_DAY0) + days * 86400 + seconds)


def _ingested(run_day: Column, load: int) -> Column:
    return _instant(run_day + 1, F.lit(load))


# The columns used of the input tables.
_COLUMNS = {
    "orders": "o_orderkey long, o_custkey long, o_totalprice double",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Dealt out by key, so that few files are not fanned out by as few tasks."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def _rate(merchant: Column, version: Column) -> Column:
    return ((F.lit(50) + (merchant * 37 + version * 53) % 251) / F.lit(10000)).cast("decimal(6,4)")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their rolls; small remainders by distinct primes stay independent."""
    o = _spread(_table(spark, sf_dir, "orders"), "o_orderkey")
    suppliers = F.lit(_table(spark, sf_dir, "supplier").count())
    k = F.col("o_orderkey")

    def roll(factor: int, modulus: int, below: int) -> Column:
        return (k * factor) % modulus < below

    o = o.select(
        k.alias("k"),
        F.concat(F.lit("ORD-"), k).alias("order_id"),
        F.concat(F.lit("TXN-"), k).alias("txn_id"),
        (F.col("o_custkey") % suppliers).alias("merchant"),
        F.concat(F.lit("c"), "o_custkey", F.lit("@bank")).alias("customer_vpa"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        (k % 10).alias("d"),
        ((k * 7919) % 86400).alias("s"),
        F.when(roll(31, 997, 20), "created").when(roll(31, 997, 170), "failed")
        .when(roll(31, 997, 220), "refunded").otherwise("paid").alias("init_status"),
        roll(37, 1009, 10).alias("flipped"),
        roll(41, 1013, 10).alias("charged_twice"),
        roll(43, 1019, 20).alias("unsettled"),
        roll(47, 1021, 30).alias("late"),
        roll(53, 1031, 15).alias("off_amount"),
        roll(59, 1049, 5).alias("ghost"),
        roll(61, 1033, 10).alias("broken"),
    )
    pending = F.col("init_status") == "created"
    o = o.withColumns({
        "merchant_id": F.concat(F.lit("M"), "merchant"),
        "pay_d": F.when(pending, F.col("d") + 1 + F.col("k") % 2).otherwise(F.col("d")),
        "fin_status": F.when(pending, F.when(F.col("k") % 5 == 0, "failed").otherwise("paid"))
        .otherwise(F.col("init_status")),
        "created_at": _instant(F.col("d"), F.col("s")),
    })
    agrees = F.col("fin_status").isin("paid", "refunded") == ~F.col("flipped")
    return o.withColumns({
        "pay_time": F.when(pending, _instant(F.col("pay_d"), F.lit(43200))).otherwise(F.col("created_at")),
        "gw_status": F.when(agrees, "success").otherwise("failed"),
        "paid_in_window": F.col("pay_d") <= LAST_DAY,
    })


def _fan_out(base: DataFrame, *rows: Column) -> DataFrame:
    """One output row per struct that is not NULL."""
    return base.select(F.explode(F.array(*rows)).alias("row")).where("row is not null").select("row.*")


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants as they stood on the first day."""
    key = F.col("s_suppkey")
    start = F.lit(_EPOCH_DAY0).cast("long")
    categories = F.array(*[F.lit(c) for c in CATEGORIES])
    return _table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("M"), key).alias("merchant_id"),
        F.col("s_name").alias("name"),
        F.get(categories, (F.col("s_nationkey") % 4).cast("int")).alias("category"),
        _rate(key, F.lit(0)).alias("fee_rate"),
        F.timestamp_seconds(start).alias("created_at"),
        F.timestamp_seconds(start).alias("updated_at"),
    )


def merchant_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every state of every merchant: the first day's and each later fee change."""
    s = _table(spark, sf_dir, "supplier")
    suppliers = F.lit(s.count())
    key, t = F.col("s_suppkey"), F.col("t")
    days = F.sequence(F.lit(0).cast("long"), F.lit(LAST_DAY).cast("long"))
    changes = (
        s.select("*", F.explode(days).alias("t"))
        .where((t == 0) | ((key + t * 7) % suppliers < 3))
    )
    categories = F.array(*[F.lit(c) for c in CATEGORIES])
    return changes.select(
        F.concat(F.lit("M"), key).alias("merchant_id"),
        F.col("s_name").alias("name"),
        F.get(categories, (F.col("s_nationkey") % 4).cast("int")).alias("category"),
        _rate(key, t).alias("fee_rate"),
        _instant(F.lit(0), F.lit(0)).alias("created_at"),
        _instant(t, F.when(t == 0, 0).otherwise(43200)).alias("updated_at"),
    )


def raw_orders(base: DataFrame) -> DataFrame:
    def load(status: str, updated_at: str, run_day: str, number: int) -> Column:
        return F.struct(
            "order_id", "merchant_id", "customer_vpa", "amount",
            F.col(status).alias("status"), "created_at", F.col(updated_at).alias("updated_at"),
            _date(F.col(run_day)).alias("run_date"), _ingested(F.col(run_day), number).alias("ingested_at"),
        )

    resolved = (F.col("init_status") == "created") & F.col("paid_in_window")
    return _fan_out(
        base,
        load("init_status", "created_at", "d", 1),
        F.when(resolved, load("fin_status", "pay_time", "pay_d", 2)),
    )


def app_orders(base: DataFrame) -> DataFrame:
    """The application's order table as it stands after the last day."""
    resolved = (F.col("init_status") == "created") & F.col("paid_in_window")
    return base.select(
        "order_id", "merchant_id", "customer_vpa", "amount",
        F.when(resolved, F.col("fin_status")).otherwise(F.col("init_status")).alias("status"),
        "created_at",
        F.when(resolved, F.col("pay_time")).otherwise(F.col("created_at")).alias("updated_at"),
    )


def _event(txn: Column, order: Column, status: Column, when: Column, run_day: Column, load: int) -> Column:
    return F.struct(
        txn.alias("txn_id"), order.alias("order_id"), status.alias("gateway_status"), "amount",
        when.alias("event_time"), F.lit("payment").alias("event_type"),
        _date(run_day).alias("run_date"), _ingested(run_day, load).alias("ingested_at"),
    )


def raw_gateway(base: DataFrame) -> DataFrame:
    c, k = F.col, F.col("k")
    txn, order, status, paid, on = c("txn_id"), c("order_id"), c("gw_status"), c("pay_time"), c("pay_d")
    intact = c("paid_in_window") & ~c("broken")
    again = paid + F.make_dt_interval(F.lit(0), F.lit(0), (F.lit(1) + k % 5).cast("int"))
    return _fan_out(
        base,
        F.when(intact, _event(txn, order, status, paid, on, 1)),
        F.when(
            c("charged_twice") & c("paid_in_window"),
            _event(F.concat(F.lit("TXN-D"), k), order, status, again, on, 1),
        ),
        F.when(
            c("ghost"),
            _event(
                F.concat(F.lit("TXN-G"), k), F.concat(F.lit("ORD-GHOST-"), k), F.lit("success"),
                c("created_at"), c("d"), 1,
            ),
        ),
        F.when(
            intact & (k % 211 == 0) & (on < LAST_DAY), _event(txn, order, status, paid, on + 1, 2),
        ),
    )


def raw_settlements(base: DataFrame) -> DataFrame:
    c, k = F.col, F.col("k")
    lag = F.when(c("late"), F.lit(3) + k % 4).otherwise(1)
    extra = F.when(c("off_amount"), F.lit(1) + k % 500).otherwise(0).cast("decimal(12,2)")
    paid = base.where(
        c("paid_in_window") & (c("gw_status") == "success") & ~c("unsettled")
    ).withColumns({
        "gross": (c("amount") + extra).cast("decimal(12,2)"),
        "rate": _rate(c("merchant"), F.lit(0)),
        "settle_d": c("pay_d") + lag,
    })
    fee, tax, net = fee_split(c("gross"), c("rate"))

    def line(prefix: str, amounts: list[Column], on: Column, kind: str) -> Column:
        gross, mdr, gst, left = [a.cast("decimal(12,2)") for a in amounts]
        return F.struct(
            F.concat(F.lit(prefix), k).alias("settlement_id"), "txn_id",
            gross.alias("gross_amount"), mdr.alias("mdr_fee"), gst.alias("gst_on_fee"),
            left.alias("net_settled"), _date(on).alias("settled_date"),
            F.lit(kind).alias("settlement_type"),
            _date(on).alias("run_date"), _ingested(on, 1).alias("ingested_at"),
        )

    refund_d = c("settle_d") + 1 + k % 3
    nothing = F.lit(0)
    return _fan_out(
        paid,
        F.when(c("settle_d") <= LAST_DAY, line("SET-", [c("gross"), fee, tax, net], c("settle_d"), "payment")),
        F.when(
            (c("fin_status") == "refunded") & (refund_d <= LAST_DAY),
            line("SET-R", [-c("gross"), nothing, nothing, -c("gross")], refund_d, "refund"),
        ),
    )


def redelivered_settlements(raw: DataFrame) -> DataFrame:
    """Settlement rows as a bank sends them: some twice with another amount, some transactions
    settled again later, earlier in name or without a date, some rows without a type."""
    c, t = F.col, F.substring("txn_id", 5, 20).cast("long")
    untyped = raw.withColumn(
        "settlement_type", F.when((t % 19 != 0) | (c("settlement_type") != "payment"), c("settlement_type"))
    )
    first_try = raw.where(t % 11 == 0).withColumns({
        "gross_amount": (c("gross_amount") + 1).cast("decimal(12,2)"),
        "ingested_at": c("ingested_at") - F.expr("INTERVAL 1 HOUR"),
    })

    def again(which: Column, prefix: str, on: Column) -> DataFrame:
        return raw.where(which).withColumns({
            "settlement_id": F.concat(F.lit(prefix), "settlement_id"), "settled_date": on,
            "net_settled": (c("net_settled") - 1).cast("decimal(12,2)"),
        })

    later = again(t % 13 == 0, "B", F.date_add("settled_date", 1))
    tied = again(t % 17 == 0, "A", c("settled_date"))
    undated = again(t % 23 == 0, "A", F.lit(None).cast("date"))
    return untyped.unionByName(first_try).unionByName(later).unionByName(tied).unionByName(undated.where(t % 17 != 0))


def _as_text(when: Column) -> Column:
    return F.concat(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def staged_gateway(base: DataFrame) -> DataFrame:
    """Primary gateway events as text, some of them broken on the way."""
    c, k = F.col, F.col("k")
    hit = [c("broken") & (k % 3 == i) for i in range(3)]
    amount = c("amount").cast("string")
    return base.where("paid_in_window").select(
        F.when(hit[0], "").otherwise(c("txn_id")).alias("txn_id"),
        "order_id",
        c("gw_status").alias("gateway_status"),
        F.when(hit[1], F.concat(F.lit("-"), amount)).otherwise(amount).alias("amount"),
        F.when(hit[2], "not-a-date").otherwise(_as_text(c("pay_time"))).alias("event_time"),
        F.lit("payment").alias("event_type"),
        _date(c("pay_d")).alias("run_date"),
    )


def staged_orders(base: DataFrame) -> DataFrame:
    """Order rows as text; a roll on the key breaks one of five fields."""
    c, k = F.col, F.col("o_key")
    hit = [(k * 67 % 1039 < 10) & (k % 5 == i) for i in range(5)]
    amount = c("amount").cast("string")
    raw = raw_orders(base).withColumn("o_key", F.substring("order_id", 5, 20).cast("long"))
    return raw.select(
        "order_id",
        F.when(hit[0], "").otherwise(c("merchant_id")).alias("merchant_id"),
        "customer_vpa",
        F.when(hit[1], F.concat(F.lit("-"), amount)).when(hit[2], "12,50").otherwise(amount).alias("amount"),
        F.when(hit[3], "Paid").otherwise(c("status")).alias("status"),
        F.when(hit[4], "2026-09").otherwise(_as_text(c("created_at"))).alias("created_at"),
        _as_text(c("updated_at")).alias("updated_at"),
        "run_date",
    )


def staged_settlements(base: DataFrame) -> DataFrame:
    """Settlement rows as text; a roll on the key breaks one of four fields."""
    c, k = F.col, F.col("t_key")
    hit = [(k * 71 % 1049 < 10) & (k % 4 == i) for i in range(4)]
    raw = raw_settlements(base).withColumn("t_key", F.substring("txn_id", 5, 20).cast("long"))

    def text(name: str) -> Column:
        return c(name).cast("string")

    return raw.select(
        "settlement_id",
        F.when(hit[0], "").otherwise(c("txn_id")).alias("txn_id"),
        text("gross_amount").alias("gross_amount"),
        F.when(hit[1], F.concat(F.lit("-"), text("mdr_fee"))).otherwise(text("mdr_fee")).alias("mdr_fee"),
        text("gst_on_fee").alias("gst_on_fee"),
        text("net_settled").alias("net_settled"),
        F.when(hit[2], "2026-02-30").otherwise(text("settled_date")).alias("settled_date"),
        F.when(hit[3], "chargeback").otherwise(c("settlement_type")).alias("settlement_type"),
        "run_date",
    )


def truth(base: DataFrame) -> DataFrame:
    """What was done to each order, one boolean per fault, for the answer key."""
    c = F.col
    return base.select(
        "order_id", "merchant_id", "amount",
        F.when(c("paid_in_window"), c("fin_status")).otherwise("pending").alias("order_status"),
        (~c("paid_in_window")).alias("is_pending"),
        (c("gw_status") == "success").alias("succeeded"),
        c("unsettled").alias("missing_settlement"),
        c("flipped").alias("status_mismatch"),
        c("broken").alias("invalid_row"),
        c("charged_twice").alias("duplicate_charge"),
        c("late").alias("late_settlement"),
        c("off_amount").alias("amount_mismatch"),
        (c("fin_status") == "refunded").alias("refunded"),
    )


def load_days(spark: SparkSession) -> DataFrame:
    """The days loaded so far, as a run log with one step per day."""
    return spark.range(LAST_DAY + 1).select(
        _date(F.col("id")).alias("run_date"), F.lit("load").alias("step")
    )


# What was done to an order, the first that holds, and the result to expect of it.
_LABELS = [
    ("pending", "is_pending", "pending"),
    ("missing_settlement", "succeeded AND missing_settlement", "discrepancy"),
    ("status_mismatch", "status_mismatch", "discrepancy"),
    ("invalid_row", "invalid_row", "discrepancy"),
    ("duplicate_charge", "duplicate_charge", "discrepancy"),
    ("none", "NOT succeeded", "match"),
    ("late_settlement", "late_settlement", "discrepancy"),
    ("amount_mismatch", "amount_mismatch", "discrepancy"),
    ("refund", "refunded", "refunded"),
    ("clean", "true", "match"),
]


def answer_key(truth: DataFrame) -> DataFrame:
    """One label per order and the result it calls for, from ``truth``.

    A missing settlement overrides every other label; faults of the settlement itself count
    only where the payment succeeded.
    """
    holding = F.filter(F.array(*[
        F.when(F.expr(condition), F.struct(F.lit(label).alias("label"), F.lit(result).alias("result")))
        for label, condition, result in _LABELS
    ]), lambda x: x.isNotNull())
    return truth.withColumn("_first", holding[0]).select(
        "order_id", "merchant_id", "amount", "order_status",
        F.col("_first.label").alias("error_type"), F.col("_first.result").alias("expected_result"),
    )
