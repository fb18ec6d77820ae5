"""Table schemas and row contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
RATE = T.DecimalType(6, 4)


def _table(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in cols])


_S, _TS, _D = T.StringType(), T.TimestampType(), T.DateType()

MERCHANTS = _table(
    ("merchant_id", _S), ("name", _S), ("category", _S), ("fee_rate", RATE),
    ("created_at", _TS), ("updated_at", _TS),
)
ORDERS = _table(
    ("order_id", _S), ("merchant_id", _S), ("customer_vpa", _S), ("amount", MONEY),
    ("status", _S), ("created_at", _TS), ("updated_at", _TS),
)
GATEWAY = _table(
    ("txn_id", _S), ("order_id", _S), ("gateway_status", _S), ("amount", MONEY),
    ("event_time", _TS), ("event_type", _S),
)
SETTLEMENTS = _table(
    ("settlement_id", _S), ("txn_id", _S), ("gross_amount", MONEY), ("mdr_fee", MONEY),
    ("gst_on_fee", MONEY), ("net_settled", MONEY), ("settled_date", _D), ("settlement_type", _S),
)
_LOAD = _table(("ingested_at", _TS), ("run_date", _D))
RAW_ORDERS = T.StructType(ORDERS.fields + _LOAD.fields)
RAW_GATEWAY = T.StructType(GATEWAY.fields + _LOAD.fields)
RAW_SETTLEMENTS = T.StructType(SETTLEMENTS.fields + _LOAD.fields)
REJECTED = _table(
    ("row_data", _S), ("reason", _S), ("rejected_at", _TS), ("run_date", _D), ("source", _S),
)
RUN_LOG = _table(
    ("rows_in", T.LongType()), ("rows_out", T.LongType()), ("rows_rejected", T.LongType()),
    ("duration_seconds", T.DecimalType(8, 2)), ("created_at", _TS), ("run_date", _D), ("step", _S),
)
ANSWER_KEY = _table(
    ("order_id", _S), ("merchant_id", _S), ("amount", MONEY), ("order_status", _S),
    ("error_type", _S), ("expected_result", _S),
)
SNAPSHOT = T.StructType(MERCHANTS.fields + _table(("valid_from", _TS), ("valid_to", _TS)).fields)

# The allowed codes.
ORDER_STATUSES = ("created", "paid", "failed", "refunded")
GATEWAY_STATUSES = ("success", "failed")
SETTLEMENT_TYPES = ("payment", "refund")
RECONCILIATION_STATUSES = ("matched", "discrepancy", "pending", "refunded")
EXPECTED_RESULTS = ("match", "discrepancy", "pending", "refunded")
# Error type -> the fact's flag that detects it.
DETECTORS = {
    "missing_settlement": "is_missing_settlement",
    "late_settlement": "is_late_settlement",
    "amount_mismatch": "is_amount_mismatch",
    "duplicate_charge": "is_duplicate_charge",
    "status_mismatch": "is_status_mismatch",
}
MATURITY_DAYS = 5


@dataclass(frozen=True)
class Contract:
    """What a source row must satisfy. Field order decides which failure is reported."""

    source: str
    schema: T.StructType
    numeric: tuple[str, ...]
    timestamps: tuple[str, ...]
    allowed: dict[str, tuple[str, ...]]
    signed_on_refund: tuple[str, ...] = field(default=())

    @property
    def required(self) -> list[str]:
        return self.schema.fieldNames()


CONTRACTS = {
    "orders": Contract(
        "orders", ORDERS, ("amount",), ("created_at", "updated_at"), {"status": ORDER_STATUSES},
    ),
    "gateway": Contract(
        "gateway", GATEWAY, ("amount",), ("event_time",), {"gateway_status": GATEWAY_STATUSES},
    ),
    "settlement": Contract(
        "settlement", SETTLEMENTS,
        ("gross_amount", "mdr_fee", "gst_on_fee", "net_settled"), ("settled_date",),
        {"settlement_type": SETTLEMENT_TYPES}, ("gross_amount", "net_settled"),
    ),
}
