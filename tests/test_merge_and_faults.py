from conftest import by
from ledgerline.operators import merge
from ledgerline.plans import fixtures

TABLE = "k string, a int, b int"


def test_upsert_inserts_whole_rows_and_updates_a_subset(spark):
    old = spark.createDataFrame([("x", 1, 1), ("y", 2, 2), ("n", 3, 3)], TABLE)
    new = spark.createDataFrame([("y", 20, 20), ("z", 30, 30), ("n", 9, None)], TABLE)
    got = [tuple(r.values()) for r in by(merge.upsert(old, new, "k", ["b"]), "k")]
    assert got == [("n", 3, None), ("x", 1, 1), ("y", 2, 20), ("z", 30, 30)]


def test_replace_keys_touches_only_the_batch(spark):
    old = spark.createDataFrame([("x", 1, 1), ("y", 2, 2), ("y", 3, 3), (None, 4, 4)], TABLE)
    new = spark.createDataFrame([("y", 9, 9), ("w", 8, 8)], TABLE)
    got = [tuple(r.values()) for r in by(merge.replace_keys(old, new, "k"), "k", "a")]
    assert got == [("w", 8, 8), ("x", 1, 1), ("y", 9, 9), (None, 4, 4)]


def test_labels_follow_precedence(spark):
    base = dict(order_id="o", merchant_id="m", amount=1, order_status="paid", is_pending=False, succeeded=True,
                missing_settlement=False, status_mismatch=False, invalid_row=False, duplicate_charge=False,
                late_settlement=False, amount_mismatch=False, refunded=False)
    every = {k: True for k in base if isinstance(base[k], bool) and k not in ("is_pending", "succeeded")}
    cases = [
        ({}, "clean", "match"), ({"is_pending": True, **every}, "pending", "pending"),
        (every, "missing_settlement", "discrepancy"),
        ({**every, "missing_settlement": False}, "status_mismatch", "discrepancy"),
        ({**every, "succeeded": False}, "status_mismatch", "discrepancy"),
        ({"succeeded": False, "late_settlement": True, "refunded": True}, "none", "match"),
        ({"invalid_row": True, "duplicate_charge": True}, "invalid_row", "discrepancy"),
        ({"late_settlement": True, "amount_mismatch": True}, "late_settlement", "discrepancy"),
        ({"refunded": True, "amount_mismatch": True}, "amount_mismatch", "discrepancy"),
        ({"refunded": True}, "refund", "refunded"),
    ]
    df = spark.createDataFrame([{**base, **change, "order_id": str(n)} for n, (change, _, _) in enumerate(cases)])
    got = {r.order_id: (r.error_type, r.expected_result) for r in fixtures.answer_key(df).collect()}
    assert got == {str(n): (label, result) for n, (_, label, result) in enumerate(cases)}
