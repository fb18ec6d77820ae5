"""The catalogue's queries as plain SQL over the input tables.

Written apart from the DataFrame code, so that agreement means something: windows
where that groups, joins where that forwards, integer rounding where that divides.
"""

from __future__ import annotations

import re

# Derived tables. d0 is the first day; each name builds on those above it.
_TABLES = {
    "supplier_count": "SELECT count(*) AS n_sup FROM supplier",
    "merchant_states": """
        SELECT 'M' || s_suppkey AS merchant_id, s_name AS name,
          CASE s_nationkey % 4 WHEN 0 THEN 'bakery' WHEN 1 THEN 'hardware'
            WHEN 2 THEN 'travel' ELSE 'books' END AS category,
          CAST((50 + (s_suppkey * 37 + t * 53) % 251) / 10000.0 AS DECIMAL(6,4)) AS fee_rate,
          TIMESTAMP '2026-09-01' AS created_at,
          TIMESTAMP '2026-09-01' + to_seconds(t * 86400 + CASE WHEN t = 0 THEN 0 ELSE 43200 END) AS updated_at
        FROM supplier, supplier_count, (SELECT unnest(range(10)) AS t) AS days
        WHERE t = 0 OR (s_suppkey + 7 * t) % n_sup < 3""",
    "versions": """
        SELECT *, updated_at AS valid_from,
          lead(updated_at) OVER (PARTITION BY merchant_id ORDER BY updated_at) AS valid_to
        FROM merchant_states""",
    "rolls": """
        SELECT o_orderkey AS k, 'ORD-' || o_orderkey AS order_id, 'TXN-' || o_orderkey AS txn_id,
          'M' || (o_custkey % n_sup) AS merchant_id, 'c' || o_custkey || '@bank' AS customer_vpa,
          CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
          o_orderkey % 10 AS d, o_orderkey * 7919 % 86400 AS s,
          o_orderkey * 31 % 997 AS r_st, o_orderkey * 37 % 1009 AS r_sm, o_orderkey * 41 % 1013 AS r_dup,
          o_orderkey * 43 % 1019 AS r_miss, o_orderkey * 47 % 1021 AS r_late, o_orderkey * 53 % 1031 AS r_amt,
          o_orderkey * 59 % 1049 AS r_orph, o_orderkey * 61 % 1033 AS r_inv
        FROM orders, supplier_count""",
    "paid": """
        SELECT *, CASE WHEN r_st < 20 THEN d + 1 + k % 2 ELSE d END AS pay_d,
          CASE WHEN r_st < 20 THEN 'created' WHEN r_st < 170 THEN 'failed'
            WHEN r_st < 220 THEN 'refunded' ELSE 'paid' END AS init_status,
          CASE WHEN r_st < 20 AND k % 5 = 0 THEN 'failed' WHEN r_st < 20 THEN 'paid'
            WHEN r_st < 170 THEN 'failed' WHEN r_st < 220 THEN 'refunded' ELSE 'paid' END AS fin_status,
          TIMESTAMP '2026-09-01' + to_seconds(d * 86400 + s) AS created_at
        FROM rolls""",
    "base": """
        SELECT *,
          CASE WHEN r_st < 20 THEN TIMESTAMP '2026-09-01' + to_seconds(pay_d * 86400 + 43200)
            ELSE created_at END AS pay_time,
          CASE WHEN (fin_status IN ('paid', 'refunded')) = (r_sm >= 10) THEN 'success' ELSE 'failed' END AS gw_status
        FROM paid""",
    "order_loads": """
        SELECT k, order_id, merchant_id, customer_vpa, amount, init_status AS status, created_at,
          created_at AS updated_at, d AS load_d, 1 AS load_no
        FROM base
        UNION ALL
        SELECT k, order_id, merchant_id, customer_vpa, amount, fin_status, created_at, pay_time, pay_d, 2
        FROM base WHERE r_st < 20 AND pay_d <= 9""",
    "event_loads": """
        SELECT txn_id, order_id, gw_status AS gateway_status, amount, pay_time AS event_time,
          pay_d AS load_d, 1 AS load_no
        FROM base WHERE pay_d <= 9 AND r_inv >= 10
        UNION ALL
        SELECT 'TXN-D' || k, order_id, gw_status, amount, pay_time + to_seconds(60 * (1 + k % 5)), pay_d, 1
        FROM base WHERE pay_d <= 9 AND r_dup < 10
        UNION ALL
        SELECT 'TXN-G' || k, 'ORD-GHOST-' || k, 'success', amount, created_at, d, 1
        FROM base WHERE r_orph < 5
        UNION ALL
        SELECT txn_id, order_id, gw_status, amount, pay_time, pay_d + 1, 2
        FROM base WHERE pay_d <= 8 AND r_inv >= 10 AND k % 211 = 0""",
    "lines": """
        SELECT b.k, b.txn_id, b.fin_status, m.fee_rate,
          b.amount + CAST(CASE WHEN r_amt < 15 THEN 1 + k % 500 ELSE 0 END AS DECIMAL(12,2)) AS gross,
          pay_d + CASE WHEN r_late < 30 THEN 3 + k % 4 ELSE 1 END AS settle_d
        FROM base AS b JOIN merchant_states AS m
          ON m.merchant_id = b.merchant_id AND m.updated_at = TIMESTAMP '2026-09-01'
        WHERE pay_d <= 9 AND gw_status = 'success' AND r_miss >= 20""",
    "line_fees": """
        SELECT *, round(gross * fee_rate, 2) AS mdr,
          round(round(gross * fee_rate, 2) * CAST(0.18 AS DECIMAL(3,2)), 2) AS gst
        FROM lines""",
    "settlement_loads": """
        SELECT 'SET-' || k AS settlement_id, txn_id, CAST(gross AS DECIMAL(12,2)) AS gross_amount,
          CAST(mdr AS DECIMAL(12,2)) AS mdr_fee, CAST(gst AS DECIMAL(12,2)) AS gst_on_fee,
          CAST(gross - mdr - gst AS DECIMAL(12,2)) AS net_settled,
          settle_d AS load_d, 'payment' AS settlement_type
        FROM line_fees WHERE settle_d <= 9
        UNION ALL
        SELECT 'SET-R' || k, txn_id, CAST(-gross AS DECIMAL(12,2)), 0, 0, CAST(-gross AS DECIMAL(12,2)),
          settle_d + 1 + k % 3, 'refund'
        FROM line_fees WHERE fin_status = 'refunded' AND settle_d + 1 + k % 3 <= 9""",
    "raw_o": """
        SELECT * EXCLUDE (load_d, load_no), DATE '2026-09-01' + CAST(load_d AS INTEGER) AS run_date,
          TIMESTAMP '2026-09-01' + to_seconds((load_d + 1) * 86400 + load_no) AS ingested_at
        FROM order_loads""",
    "raw_g": """
        SELECT * EXCLUDE (load_d, load_no), 'payment' AS event_type,
          DATE '2026-09-01' + CAST(load_d AS INTEGER) AS run_date,
          TIMESTAMP '2026-09-01' + to_seconds((load_d + 1) * 86400 + load_no) AS ingested_at
        FROM event_loads""",
    "raw_s": """
        SELECT * EXCLUDE (load_d), DATE '2026-09-01' + CAST(load_d AS INTEGER) AS settled_date,
          DATE '2026-09-01' + CAST(load_d AS INTEGER) AS run_date
        FROM settlement_loads""",
    "so": """
        SELECT * EXCLUDE (k, ingested_at) FROM raw_o
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ingested_at DESC) = 1""",
    "sg": """
        SELECT * EXCLUDE (ingested_at) FROM raw_g
        QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY ingested_at DESC) = 1""",
    "ss": "SELECT * FROM raw_s",
    "sent_s": """
        SELECT * EXCLUDE (load_d), load_d AS settled_d, load_d, 1 AS load_no, CAST(substr(txn_id, 5) AS BIGINT) AS t
        FROM settlement_loads""",
    "delivered_s": """
        SELECT * REPLACE (CASE WHEN t % 19 = 0 AND settlement_type = 'payment' THEN NULL ELSE settlement_type END
          AS settlement_type) FROM sent_s
        UNION ALL SELECT * REPLACE (gross_amount + 1 AS gross_amount, 0 AS load_no) FROM sent_s WHERE t % 11 = 0
        UNION ALL SELECT * REPLACE ('B' || settlement_id AS settlement_id, settled_d + 1 AS settled_d,
          net_settled - 1 AS net_settled) FROM sent_s WHERE t % 13 = 0
        UNION ALL SELECT * REPLACE ('A' || settlement_id AS settlement_id, net_settled - 1 AS net_settled)
          FROM sent_s WHERE t % 17 = 0
        UNION ALL SELECT * REPLACE ('A' || settlement_id AS settlement_id, CAST(NULL AS BIGINT) AS settled_d,
          net_settled - 1 AS net_settled) FROM sent_s WHERE t % 23 = 0 AND t % 17 <> 0""",
    "kept_s": """
        SELECT settlement_id, txn_id, CAST(gross_amount AS DECIMAL(12,2)) AS gross_amount, mdr_fee, gst_on_fee,
          CAST(net_settled AS DECIMAL(12,2)) AS net_settled, DATE '2026-09-01' + CAST(settled_d AS INTEGER) AS settled_date,
          coalesce(settlement_type, 'payment') AS settlement_type, DATE '2026-09-01' + CAST(load_d AS INTEGER) AS run_date
        FROM delivered_s
        QUALIFY row_number() OVER (PARTITION BY settlement_id ORDER BY load_d DESC, load_no DESC) = 1""",
    "pay": """
        SELECT txn_id, settlement_id, gross_amount, mdr_fee, gst_on_fee, net_settled, settled_date
        FROM ss WHERE settlement_type = 'payment'
        QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY settled_date, settlement_id) = 1""",
    "back": """
        SELECT txn_id, settlement_id AS refund_settlement_id, net_settled AS refund_amount,
          settled_date AS refund_date
        FROM ss WHERE settlement_type = 'refund'
        QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY settled_date, settlement_id) = 1""",
    "first_event": """
        SELECT order_id, txn_id, gateway_status, amount AS gateway_amount, event_time AS gateway_event_time,
          count(*) OVER (PARTITION BY order_id) AS event_count,
          sum(CASE WHEN gateway_status = 'success' THEN 1 ELSE 0 END)
            OVER (PARTITION BY order_id) AS success_event_count
        FROM sg
        QUALIFY row_number() OVER (
          PARTITION BY order_id ORDER BY CASE gateway_status WHEN 'success' THEN 0 ELSE 1 END, event_time, txn_id
        ) = 1""",
    "lost": """
        SELECT sg.order_id, sg.txn_id, gateway_status, sg.amount AS gateway_amount,
          event_time AS gateway_event_time, CAST(1 AS BIGINT) AS event_count,
          settlement_id, gross_amount, net_settled, settled_date, TRUE AS is_orphan_payment
        FROM sg LEFT JOIN pay USING (txn_id)
        WHERE gateway_status = 'success' AND NOT EXISTS (SELECT 1 FROM so WHERE so.order_id = sg.order_id)""",
    "side_by_side": """
        SELECT order_id, merchant_id, amount AS order_amount, status AS order_status,
          created_at AS order_created_at, txn_id, gateway_status, gateway_amount, gateway_event_time,
          coalesce(event_count, 0) AS event_count, settlement_id, gross_amount, net_settled, settled_date,
          refund_settlement_id, refund_amount, refund_date, FALSE AS is_orphan_payment
        FROM so LEFT JOIN first_event USING (order_id) LEFT JOIN pay USING (txn_id) LEFT JOIN back USING (txn_id)
        UNION ALL BY NAME
        SELECT * FROM lost""",
    # What an order's status and its payment's say together; an unknown order or payment leaves things open.
    "status_cases": """
        SELECT * FROM (VALUES
          ('paid', 'success', FALSE, TRUE), ('paid', 'failed', TRUE, FALSE), ('paid', 'none', TRUE, NULL),
          ('refunded', 'success', FALSE, TRUE), ('refunded', 'failed', TRUE, FALSE), ('refunded', 'none', TRUE, NULL),
          ('failed', 'success', TRUE, FALSE), ('failed', 'failed', FALSE, FALSE), ('failed', 'none', NULL, FALSE),
          ('created', 'success', FALSE, FALSE), ('created', 'failed', FALSE, FALSE), ('created', 'none', FALSE, FALSE),
          ('unknown', 'success', NULL, NULL)
        ) AS v(order_case, payment_case, contradicts, awaits_settlement)""",
    "flagged": """
        SELECT side_by_side.*, event_count > 1 AS is_duplicate_charge, contradicts AS is_status_mismatch,
          CASE WHEN settlement_id IS NOT NULL THEN FALSE ELSE awaits_settlement END AS is_missing_settlement,
          CASE WHEN settlement_id IS NULL OR order_amount IS NULL THEN FALSE
            ELSE gross_amount <> order_amount END AS is_amount_mismatch,
          CASE WHEN settlement_id IS NULL OR settled_date IS NULL OR gateway_event_time IS NULL THEN FALSE
            ELSE settled_date - CAST(gateway_event_time AS DATE) > 1 END AS is_late_settlement,
          refund_settlement_id IS NOT NULL AS is_refunded
        FROM side_by_side LEFT JOIN status_cases
          ON order_case = coalesce(order_status, 'unknown') AND payment_case = coalesce(gateway_status, 'none')""",
    "fact": """
        SELECT *, CASE
            WHEN order_status = 'created' THEN 'pending'
            WHEN is_orphan_payment OR is_duplicate_charge OR is_status_mismatch OR is_missing_settlement
              OR is_amount_mismatch OR is_late_settlement THEN 'discrepancy'
            WHEN gateway_status = 'failed' AND order_status = 'failed' THEN 'matched'
            WHEN gateway_status = 'success' AND settlement_id IS NOT NULL THEN CASE
              WHEN order_status = 'paid' THEN 'matched'
              WHEN order_status = 'refunded' AND is_refunded THEN 'refunded'
              ELSE 'discrepancy' END
            ELSE 'discrepancy' END AS reconciliation_status
        FROM flagged""",
    "payments": """
        SELECT sg.txn_id, sg.order_id, gateway_status, sg.amount AS gateway_amount, event_time, event_type,
          merchant_id, status AS order_status, so.amount AS order_amount, so.order_id IS NULL AS is_orphan_payment,
          settlement_id, gross_amount, mdr_fee, gst_on_fee, net_settled, settled_date,
          settlement_id IS NOT NULL AS is_settled, refund_settlement_id, refund_amount, refund_date,
          refund_settlement_id IS NOT NULL AS is_refunded
        FROM sg LEFT JOIN so USING (order_id) LEFT JOIN pay USING (txn_id) LEFT JOIN back USING (txn_id)""",
    "daily": """
        SELECT report_date, count(*) AS total_orders,
          count(*) FILTER (is_matched = 1) AS matched_count, count(*) FILTER (is_open = 1) AS discrepancy_count,
          count(*) FILTER (is_returned = 1) AS refunded_count, count(*) FILTER (is_pending = 1) AS pending_count,
          ((20000 * sum(is_open) + count(*)) // (2 * count(*))) / 100.0 AS discrepancy_rate_pct,
          sum(CASE WHEN is_open = 1 THEN order_amount END) AS discrepancy_amount,
          sum(CASE WHEN settlement_id IS NULL AND order_status IN ('paid', 'refunded')
            AND gateway_status = 'success' THEN order_amount END) AS unsettled_amount,
          sum(net_settled) AS total_net_settled,
          CASE WHEN sum(is_open) > 0 THEN ((20 * sum(is_open * age) + sum(is_open)) // (2 * sum(is_open))) / 10.0
            END AS avg_discrepancy_age_days,
          max(CASE WHEN is_open = 1 THEN age END) AS max_discrepancy_age_days
        FROM (
          SELECT *, CAST(order_created_at AS DATE) AS report_date,
            date_diff('day', CAST(order_created_at AS DATE), DATE '2026-09-10') AS age,
            CASE reconciliation_status WHEN 'matched' THEN 1 ELSE 0 END AS is_matched,
            CASE reconciliation_status WHEN 'discrepancy' THEN 1 ELSE 0 END AS is_open,
            CASE reconciliation_status WHEN 'refunded' THEN 1 ELSE 0 END AS is_returned,
            CASE reconciliation_status WHEN 'pending' THEN 1 ELSE 0 END AS is_pending
          FROM fact WHERE order_created_at IS NOT NULL
        ) AS rows_by_day
        GROUP BY report_date""",
    "merchant_totals": """
        SELECT f.merchant_id, v.name, v.category, v.fee_rate, count(*) AS total_orders,
          count(*) FILTER (reconciliation_status = 'discrepancy') AS discrepancy_count,
          count(*) FILTER (is_missing_settlement) AS missing_settlement_count,
          count(*) FILTER (is_late_settlement) AS late_settlement_count,
          count(*) FILTER (is_amount_mismatch) AS amount_mismatch_count,
          count(*) FILTER (is_duplicate_charge) AS duplicate_charge_count,
          count(*) FILTER (is_status_mismatch) AS status_mismatch_count,
          sum(CASE WHEN reconciliation_status = 'discrepancy' THEN order_amount END) AS discrepancy_amount
        FROM fact AS f JOIN versions AS v ON v.merchant_id = f.merchant_id AND v.valid_to IS NULL
        GROUP BY ALL""",
    "merchant_board": """
        SELECT *, ((20000 * discrepancy_count + total_orders) // (2 * total_orders)) / 100.0 AS discrepancy_rate_pct
        FROM merchant_totals""",
    "labelled": """
        SELECT order_id, merchant_id, amount,
          CASE WHEN pay_d > 9 THEN 'pending' ELSE fin_status END AS order_status,
          CASE WHEN pay_d > 9 THEN 'pending'
            WHEN gw_status = 'success' AND r_miss < 20 THEN 'missing_settlement'
            WHEN r_sm < 10 THEN 'status_mismatch'
            WHEN r_inv < 10 THEN 'invalid_row'
            WHEN r_dup < 10 THEN 'duplicate_charge'
            WHEN gw_status = 'failed' THEN 'none'
            WHEN r_late < 30 THEN 'late_settlement'
            WHEN r_amt < 15 THEN 'amount_mismatch'
            WHEN fin_status = 'refunded' THEN 'refund'
            ELSE 'clean' END AS error_type
        FROM base""",
    "answers": """
        SELECT *, CASE error_type WHEN 'none' THEN 'match' WHEN 'clean' THEN 'match'
            WHEN 'refund' THEN 'refunded' WHEN 'pending' THEN 'pending' ELSE 'discrepancy' END AS expected_result
        FROM labelled""",
    "ripe": """
        SELECT f.*, error_type, expected_result FROM fact AS f JOIN answers USING (order_id)
        WHERE NOT is_orphan_payment
          AND coalesce(gateway_event_time, order_created_at) <= TIMESTAMP '2026-09-05'""",
    "detections": """
        SELECT kind AS error_type,
          count(*) FILTER (flag AND kind = error_type) AS true_positives,
          count(*) FILTER (flag AND kind <> error_type) AS false_positives,
          count(*) FILTER (NOT flag AND kind = error_type) AS false_negatives
        FROM (
          SELECT 'missing_settlement' AS kind, error_type, is_missing_settlement AS flag FROM ripe
          UNION ALL SELECT 'late_settlement', error_type, is_late_settlement FROM ripe
          UNION ALL SELECT 'amount_mismatch', error_type, is_amount_mismatch FROM ripe
          UNION ALL SELECT 'duplicate_charge', error_type, is_duplicate_charge FROM ripe
          UNION ALL SELECT 'status_mismatch', error_type, is_status_mismatch FROM ripe
        ) AS long_form
        GROUP BY kind""",
    "scores": """
        SELECT error_type, true_positives, false_positives, false_negatives,
          ((20000 * true_positives + true_positives + false_positives)
            // nullif(2 * (true_positives + false_positives), 0)) / 10000.0 AS precision,
          ((20000 * true_positives + true_positives + false_negatives)
            // nullif(2 * (true_positives + false_negatives), 0)) / 10000.0 AS recall,
          ((40000 * true_positives + 2 * true_positives + false_positives + false_negatives)
            // nullif(2 * (2 * true_positives + false_positives + false_negatives), 0)) / 10000.0 AS f1_score
        FROM detections""",
    "text_o": """
        SELECT order_id, CASE WHEN bad AND k % 5 = 0 THEN '' ELSE merchant_id END AS merchant_id, customer_vpa,
          CASE WHEN bad AND k % 5 = 1 THEN '-' || amount WHEN bad AND k % 5 = 2 THEN '12,50'
            ELSE CAST(amount AS VARCHAR) END AS amount,
          CASE WHEN bad AND k % 5 = 3 THEN 'Paid' ELSE status END AS status,
          CASE WHEN bad AND k % 5 = 4 THEN '2026-09'
            ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%S+00:00') END AS created_at,
          strftime(updated_at, '%Y-%m-%dT%H:%M:%S+00:00') AS updated_at, run_date
        FROM (SELECT *, k * 67 % 1039 < 10 AS bad FROM raw_o) AS o""",
    "text_g": """
        SELECT CASE WHEN bad AND k % 3 = 0 THEN '' ELSE txn_id END AS txn_id, order_id, gw_status AS gateway_status,
          CASE WHEN bad AND k % 3 = 1 THEN '-' || amount ELSE CAST(amount AS VARCHAR) END AS amount,
          CASE WHEN bad AND k % 3 = 2 THEN 'not-a-date'
            ELSE strftime(pay_time, '%Y-%m-%dT%H:%M:%S+00:00') END AS event_time,
          'payment' AS event_type, DATE '2026-09-01' + CAST(pay_d AS INTEGER) AS run_date
        FROM (SELECT *, r_inv < 10 AS bad FROM base WHERE pay_d <= 9) AS g""",
    "text_s": """
        SELECT settlement_id, CASE WHEN bad AND t % 4 = 0 THEN '' ELSE txn_id END AS txn_id,
          CAST(gross_amount AS VARCHAR) AS gross_amount,
          CASE WHEN bad AND t % 4 = 1 THEN '-' || mdr_fee ELSE CAST(mdr_fee AS VARCHAR) END AS mdr_fee,
          CAST(gst_on_fee AS VARCHAR) AS gst_on_fee, CAST(net_settled AS VARCHAR) AS net_settled,
          CASE WHEN bad AND t % 4 = 2 THEN '2026-02-30' ELSE CAST(settled_date AS VARCHAR) END AS settled_date,
          CASE WHEN bad AND t % 4 = 3 THEN 'chargeback' ELSE settlement_type END AS settlement_type, run_date
        FROM (
          SELECT *, CAST(substr(txn_id, 5) AS BIGINT) AS t,
            CAST(substr(txn_id, 5) AS BIGINT) * 71 % 1049 < 10 AS bad
          FROM raw_s
        ) AS s""",
}


def _lacking(fields: list[str]) -> str:
    return "\n".join(f"WHEN coalesce({f}, '') = '' THEN 'missing required field: {f}'" for f in fields)


def _number(field: str, exempt: str = "FALSE") -> str:
    digits = f"replace(trim({field}), '_', '')"
    return f"""
      WHEN translate(lower({digits}), '0123456789.+-e', '') <> '' OR TRY_CAST({digits} AS DECIMAL(12,2)) IS NULL
        THEN 'non-numeric value for {field}: ''' || {field} || ''''
      WHEN TRY_CAST({digits} AS DOUBLE) < 0 AND NOT ({exempt}) THEN 'negative value for {field}: ' || {field}"""


def _moment(field: str) -> str:
    return f"""
      WHEN TRY_CAST({field} AS TIMESTAMPTZ) IS NULL OR strftime(TRY_CAST(left({field}, 10) AS DATE), '%Y-%m-%d') <> left({field}, 10)
        OR length({field}) < 10
        THEN 'unparseable timestamp for {field}: ''' || {field} || ''''"""


def _code(field: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"WHEN {field} NOT IN ({listed}) THEN 'unexpected value for {field}: ''' || {field} || ''''"


_FIELDS = {
    "o": ["order_id", "merchant_id", "customer_vpa", "amount", "status", "created_at", "updated_at"],
    "g": ["txn_id", "order_id", "gateway_status", "amount", "event_time", "event_type"],
    "s": [
        "settlement_id", "txn_id", "gross_amount", "mdr_fee", "gst_on_fee", "net_settled",
        "settled_date", "settlement_type",
    ],
}
_RETURNED = "settlement_type = 'refund'"
_RULES = {
    "o": [_number("amount"), _moment("created_at"), _moment("updated_at"),
          _code("status", ("created", "paid", "failed", "refunded"))],
    "g": [_number("amount"), _moment("event_time"), _code("gateway_status", ("success", "failed"))],
    "s": [_number("gross_amount", _RETURNED), _number("mdr_fee"), _number("gst_on_fee"),
          _number("net_settled", _RETURNED), _moment("settled_date"),
          _code("settlement_type", ("payment", "refund"))],
}
for _t, _fields in _FIELDS.items():
    _cases = "\n".join([_lacking(_fields), *_RULES[_t]])
    _TABLES[f"judged_{_t}"] = f"SELECT *, CASE {_cases} END AS reason FROM text_{_t}"


def _json(fields: list[str]) -> str:
    return "json_object(" + ", ".join(f"'{f}', {f}" for f in fields) + ")"


_TABLES["dead"] = "\nUNION ALL\n".join(
    f"SELECT '{source}' AS source, CAST({_json(_FIELDS[t])} AS VARCHAR) AS row_data, reason, run_date"
    f" FROM judged_{t} WHERE reason IS NOT NULL"
    for t, source in (("o", "orders"), ("g", "gateway"), ("s", "settlement"))
)
_TABLES["judged"] = "\nUNION ALL\n".join(
    f"SELECT run_date, reason IS NULL AS ok FROM judged_{t}" for t in _FIELDS
)
_TABLES["run_steps"] = """
    SELECT run_date, step, CASE WHEN step = 'load' THEN passed ELSE seen END AS rows_in,
      CASE WHEN step = 'extract' THEN seen ELSE passed END AS rows_out,
      CASE WHEN step = 'validate' THEN seen - passed ELSE 0 END AS rows_rejected
    FROM (
      SELECT run_date, count(*) AS seen, count(*) FILTER (ok) AS passed
      FROM judged GROUP BY run_date
    ) AS days, (SELECT unnest(['extract', 'validate', 'load']) AS step) AS steps"""

_BY_NAME = list(_TABLES)


def _needed(sql: str) -> list[str]:
    """The derived tables a query uses, directly or through others, in order."""
    used: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        found = {name for name in _BY_NAME if name in words} - used
        used |= found
        pending += [_TABLES[name] for name in found]
    return [name for name in _BY_NAME if name in used]


def _sql(select: str, money: str = "", dates: str = "") -> str:
    """``select`` with its derived tables, decimals as DOUBLE and dates as text."""
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in money.split()]
    casts += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    shown = f"* REPLACE ({', '.join(casts)})" if casts else "*"
    ctes = ",\n".join(f"{name} AS ({_TABLES[name]})" for name in _needed(select))
    return f"{'WITH ' if ctes else ''}{ctes}\nSELECT {shown} FROM (\n{select}\n) AS result"


_FACT_MONEY = "order_amount gateway_amount gross_amount net_settled refund_amount"
_FACT_DATES = "settled_date refund_date"
_TODAY = "run_date = DATE '2026-09-10'"


def _disagreeing(planted: str) -> str:
    """Orders old enough to be judged whose status is not the label; labels are wrong where ``planted`` holds."""
    return f"""
        SELECT order_id, reconciliation_status AS actual_status, expected_status
        FROM (
          SELECT *, CASE WHEN {planted} THEN 'pending' WHEN expected_result = 'match' THEN 'matched'
            ELSE expected_result END AS expected_status
          FROM ripe
        ) AS e
        WHERE reconciliation_status <> expected_status"""


def _null_counts() -> str:
    columns = {
        "raw_orders": ("raw_o", ["order_id"]),
        "raw_gateway": ("raw_g", ["txn_id"]),
        "raw_settlements": ("raw_s", ["settlement_id"]),
        "stg_orders": ("so", ["order_id", "merchant_id", "amount"]),
        "stg_gateway_events": ("sg", ["txn_id"]),
        "stg_settlements": ("ss", ["settlement_id", "txn_id"]),
        "fact_reconciliation": ("fact", ["order_id", "merchant_id", "txn_id", "settlement_id"]),
        "fact_payments": ("payments", ["txn_id"]),
        "daily_reconciliation_summary": ("daily", ["report_date"]),
        "merchant_discrepancy_summary": ("merchant_board", ["merchant_id"]),
        "accuracy_by_error_type": ("scores", ["error_type"]),
        "answer_key": ("answers", ["order_id"]),
    }
    parts = [
        f"SELECT '{shown}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS failures FROM {table}"
        for shown, (table, cols) in columns.items() for c in cols
    ]
    parts.append("SELECT 'dim_merchants', 'merchant_id', count(*) - count(merchant_id) FROM versions")
    parts.append("SELECT 'dim_merchants', 'dbt_valid_from', count(*) - count(valid_from) FROM versions")
    parts.append(f"SELECT 'dim_date', 'date_day', count(*) - count(date_day) FROM ({_CALENDAR}) AS c")
    return "\nUNION ALL\n".join(parts)


_CALENDAR = """
    SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) AS DATE)
      AS date_day"""


def _unique_counts() -> str:
    columns = {
        "stg_orders": ("so", "order_id"), "stg_gateway_events": ("sg", "txn_id"),
        "stg_settlements": ("ss", "settlement_id"), "dim_date": (f"({_CALENDAR}) AS c", "date_day"),
        "fact_reconciliation": ("fact", "order_id"), "fact_payments": ("payments", "txn_id"),
        "daily_reconciliation_summary": ("daily", "report_date"),
        "merchant_discrepancy_summary": ("merchant_board", "merchant_id"),
        "accuracy_by_error_type": ("scores", "error_type"),
        "raw_orders": ("raw_o", "order_id"), "raw_gateway": ("raw_g", "txn_id"),
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{shown}' AS table_name, '{c}' AS column_name, count(*) AS failures"
        f" FROM (SELECT {c} FROM {table} GROUP BY {c} HAVING count(*) > 1) AS repeated"
        for shown, (table, c) in columns.items()
    )


def _accepted_counts() -> str:
    columns = {
        "stg_orders": ("so", "status", ("created", "paid", "failed", "refunded")),
        "stg_gateway_events": ("sg", "gateway_status", ("success", "failed")),
        "stg_settlements": ("ss", "settlement_type", ("payment", "refund")),
        "fact_reconciliation": (
            "fact", "reconciliation_status", ("matched", "discrepancy", "pending", "refunded")),
        "fact_payments": ("payments", "gateway_status", ("success", "failed")),
        "answer_key": ("answers", "expected_result", ("match", "discrepancy", "pending", "refunded")),
        "staged_orders": ("text_o", "status", ("created", "paid", "failed", "refunded")),
        "staged_settlements": ("text_s", "settlement_type", ("payment", "refund")),
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{shown}' AS table_name, '{c}' AS column_name, count(*) AS failures FROM {table}"
        f" WHERE {c} NOT IN {values}"
        for shown, (table, c, values) in columns.items()
    )


_CHANGED = """
    SELECT order_id FROM so WHERE {today}
    UNION SELECT order_id FROM sg WHERE {today}
    UNION SELECT sg.order_id FROM ss JOIN sg USING (txn_id) WHERE ss.{today}""".format(today=_TODAY)

_ROLL = "CAST('0x' || substr(md5('42|{}|' || txn_id), 1, 8) AS BIGINT) % 1000000"

def _report() -> str:
    def named(kind: str, counts: str) -> str:
        return (
            f"SELECT '{kind}.' || table_name || '.' || column_name AS check_name, 'error' AS severity, failures"
            f" FROM ({counts}) AS {kind}_counts"
        )

    declared_only = (
        f"SELECT * FROM ({_null_counts()}) AS c"
        " WHERE table_name <> 'fact_reconciliation' OR column_name = 'order_id'"
    )
    no_raw = "SELECT * FROM ({}) AS c WHERE table_name NOT LIKE 'raw%' AND table_name NOT LIKE 'staged%'"
    return "\nUNION ALL\n".join([
        named("not_null", declared_only),
        named("unique", no_raw.format(_unique_counts())),
        named("accepted_values", no_raw.format(_accepted_counts())),
        """SELECT 'relationships.fact_reconciliation.merchant_id', 'error', count(*) FROM fact
           WHERE merchant_id IS NOT NULL AND merchant_id NOT IN (SELECT merchant_id FROM versions)""",
        """SELECT 'reconciliation_matches_answer_key', 'error', count(*) FROM ripe
           WHERE reconciliation_status
             <> CASE expected_result WHEN 'match' THEN 'matched' ELSE expected_result END""",
        """SELECT 'no_negative_payment_amounts', 'error',
             (SELECT count(*) FROM so WHERE amount < 0) + (SELECT count(*) FROM sg WHERE amount < 0)""",
        """SELECT 'no_daily_row_count_anomaly', 'warn', count(*) FROM (
             SELECT total_orders, lag(total_orders) OVER (ORDER BY report_date) AS before FROM daily
           ) AS d WHERE 2 * abs(total_orders - before) > before""",
        """SELECT 'no_orphan_settlements', 'warn', count(*) FROM ss
           WHERE NOT EXISTS (SELECT 1 FROM sg WHERE sg.txn_id = ss.txn_id)""",
    ])


def _padded(fmt: str) -> str:
    return f"rpad(strftime(date_day, '{fmt}'), 9, ' ')"


# Queries over tables that were brought forward by a day, and those that compute the same anew.
_BROUGHT_FORWARD = {
    "fact_payments_incremental": "fact_payments", "stg_orders_incremental": "stg_orders",
    "stg_gateway_events_incremental": "stg_gateway_events", "daily_summary_incremental": "daily_summary",
    "merchant_summary_incremental": "merchant_summary", "accuracy_incremental": "accuracy_by_error_type",
}


def oracle_sql() -> dict[str, str]:
    anew = _anew()
    return anew | {name: anew[other] for name, other in _BROUGHT_FORWARD.items()}


def _anew() -> dict[str, str]:
    return {
        "orders_incremental_pull": _sql("""
            SELECT order_id, merchant_id, customer_vpa, amount,
              CASE WHEN pay_d <= 9 THEN fin_status ELSE init_status END AS status, created_at,
              CASE WHEN pay_d <= 9 THEN pay_time ELSE created_at END AS updated_at
            FROM base
            WHERE CAST(CASE WHEN pay_d <= 9 THEN pay_time ELSE created_at END AS DATE) = DATE '2026-09-06'
            """, "amount"),
        "validate_orders": _sql("SELECT * FROM judged_o", dates="run_date"),
        "validate_gateway": _sql("SELECT * FROM judged_g", dates="run_date"),
        # An empty cell of a CSV file is read as NULL.
        "ingest_gateway_csv": _sql("""
            SELECT * REPLACE (nullif(txn_id, '') AS txn_id, nullif(order_id, '') AS order_id, nullif(event_type, '') AS event_type,
              nullif(gateway_status, '') AS gateway_status, nullif(amount, '') AS amount, nullif(event_time, '') AS event_time)
            FROM judged_g""", dates="run_date"),
        "validate_settlements": _sql("SELECT * FROM judged_s", dates="run_date"),
        "rejects_dead_letter": _sql("SELECT * FROM dead", dates="run_date"),
        "rejects_by_reason": _sql("""
            SELECT source, CASE WHEN reason LIKE 'missing%' THEN reason ELSE split_part(reason, ': ', 1) END AS kind,
              count(*) AS rejected
            FROM dead GROUP BY ALL"""),
        "stg_orders": _sql("SELECT * FROM so", "amount", "run_date"),
        "stg_gateway_events": _sql("SELECT * FROM sg", "amount", "run_date"),
        "stg_settlements": _sql(
            "SELECT * FROM kept_s", "gross_amount mdr_fee gst_on_fee net_settled", "settled_date run_date"),
        "events_per_order": _sql("""
            SELECT order_id, event_count, CAST(success_event_count AS BIGINT) AS success_event_count
            FROM first_event"""),
        "primary_gateway_event": _sql("""
            SELECT order_id, txn_id, gateway_status, gateway_amount, gateway_event_time AS event_time
            FROM first_event""", "gateway_amount"),
        "settlement_per_txn": _sql("""
            SELECT txn_id, settlement_id, gross_amount, mdr_fee, gst_on_fee, net_settled, settled_date
            FROM kept_s WHERE settlement_type = 'payment'
            QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY settled_date NULLS LAST, settlement_id) = 1
            """, "gross_amount mdr_fee gst_on_fee net_settled", "settled_date"),
        "refund_per_txn": _sql("""
            SELECT txn_id, settlement_id, gross_amount, mdr_fee, gst_on_fee, net_settled, settled_date
            FROM kept_s WHERE settlement_type = 'refund'
            QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY settled_date NULLS LAST, settlement_id) = 1
            """, "gross_amount mdr_fee gst_on_fee net_settled", "settled_date"),
        "orphan_payments": _sql("SELECT * FROM lost", "gateway_amount gross_amount net_settled", "settled_date"),
        "fact_reconciliation": _sql("SELECT * FROM fact", _FACT_MONEY, _FACT_DATES),
        "affected_orders": _sql(_CHANGED),
        # Bringing the fact forward by a day must give what a full rebuild gives.
        "fact_reconciliation_incremental": _sql("SELECT * FROM fact", _FACT_MONEY, _FACT_DATES),
        "fact_payments": _sql(
            "SELECT * FROM payments",
            "gateway_amount order_amount gross_amount mdr_fee gst_on_fee net_settled refund_amount", _FACT_DATES),
        "payments_ledger": _sql("""
            SELECT txn_id, order_id, merchant_id, event_time, gateway_status, gateway_amount, net_settled,
              settled_date, refund_amount, refund_date, is_settled, is_refunded, is_orphan_payment
            FROM payments""", "gateway_amount net_settled refund_amount", _FACT_DATES),
        "daily_summary": _sql(
            "SELECT * FROM daily",
            "discrepancy_rate_pct discrepancy_amount unsettled_amount total_net_settled avg_discrepancy_age_days",
            "report_date"),
        "status_trend": _sql("""
            SELECT report_date, matched_count, discrepancy_count, pending_count, refunded_count FROM daily""", dates="report_date"),
        "discrepancy_rate_trend": _sql(
            "SELECT report_date, discrepancy_rate_pct FROM daily", "discrepancy_rate_pct", "report_date"),
        "discrepancy_aging": _sql(
            "SELECT report_date, avg_discrepancy_age_days, max_discrepancy_age_days FROM daily",
            "avg_discrepancy_age_days", "report_date"),
        "unsettled_amount": _sql(
            "SELECT report_date, unsettled_amount FROM daily", "unsettled_amount", "report_date"),
        "merchant_summary": _sql(
            "SELECT * FROM merchant_board", "fee_rate discrepancy_rate_pct discrepancy_amount"),
        "merchant_leaderboard": _sql(
            "SELECT * FROM merchant_board ORDER BY discrepancy_rate_pct DESC, merchant_id",
            "fee_rate discrepancy_rate_pct discrepancy_amount"),
        "merchant_flag_breakdown": _sql("""
            SELECT * FROM (UNPIVOT (
              SELECT merchant_id, name, missing_settlement_count, late_settlement_count, amount_mismatch_count,
                duplicate_charge_count, status_mismatch_count FROM merchant_totals
            ) ON COLUMNS(* EXCLUDE (merchant_id, name)) INTO NAME discrepancy_type VALUE orders) AS u"""),
        "accuracy_by_error_type": _sql("SELECT * FROM scores", "precision recall f1_score"),
        "merchants_scd2": _sql("SELECT * FROM versions", "fee_rate"),
        "dim_merchants_current": _sql("""
            SELECT merchant_id, name, category, fee_rate, created_at, updated_at, valid_from AS dbt_valid_from,
              valid_to AS dbt_valid_to, TRUE AS is_current
            FROM versions WHERE valid_to IS NULL""", "fee_rate"),
        "fee_as_of_order": _sql("""
            SELECT so.order_id, so.merchant_id, so.created_at, v.fee_rate
            FROM so LEFT JOIN versions AS v ON v.merchant_id = so.merchant_id AND v.valid_from <= so.created_at
              AND (v.valid_to IS NULL OR so.created_at < v.valid_to)""", "fee_rate"),
        "dim_date": _sql(f"""
            SELECT date_day, year(date_day) AS year, month(date_day) AS month, day(date_day) AS day_of_month,
              isodow(date_day) AS day_of_week, {_padded('%A')} AS day_name, {_padded('%B')} AS month_name,
              quarter(date_day) AS quarter, isodow(date_day) >= 6 AS is_weekend, coalesce(orders, 0) AS orders
            FROM ({_CALENDAR}) AS c
            LEFT JOIN (SELECT CAST(created_at AS DATE) AS date_day, count(*) AS orders FROM so GROUP BY 1) AS p
              USING (date_day)""", dates="date_day"),
        "dq_not_null": _sql(_null_counts()),
        "dq_unique": _sql(_unique_counts()),
        "dq_accepted_values": _sql(_accepted_counts()),
        "dq_relationships": _sql("""
            SELECT 'fact_reconciliation.merchant_id' AS relation, merchant_id AS value FROM fact
            WHERE merchant_id IS NOT NULL AND merchant_id NOT IN (SELECT merchant_id FROM versions)
            UNION ALL
            SELECT 'stg_gateway_events.order_id', order_id FROM sg
            WHERE NOT EXISTS (SELECT 1 FROM so WHERE so.order_id = sg.order_id)"""),
        "dq_answer_key": _sql(_disagreeing("FALSE")),
        "dq_answer_key_planted": _sql(_disagreeing("CAST(substr(order_id, 5) AS BIGINT) % 7 = 3")),
        "dq_negative_amounts": _sql("""
            SELECT 'order' AS source, order_id AS id, TRY_CAST(amount AS DECIMAL(12,2)) AS amount FROM text_o
            WHERE amount LIKE '-%'
            UNION ALL
            SELECT 'gateway', txn_id, TRY_CAST(amount AS DECIMAL(12,2)) FROM text_g WHERE amount LIKE '-%'
            """, "amount"),
        "dq_volume_anomaly": _sql("""
            SELECT report_date, total_orders, prior_day_orders,
              CASE WHEN total_orders >= prior_day_orders THEN 1 ELSE -1 END
                * ((2000 * abs(total_orders - prior_day_orders) + prior_day_orders) // (2 * prior_day_orders)) / 10.0
                AS pct_change
            FROM (
              SELECT report_date, total_orders, lag(total_orders) OVER (ORDER BY report_date) AS prior_day_orders
              FROM (
                SELECT CAST(o_orderdate AS DATE) AS report_date, count(*) AS total_orders FROM orders GROUP BY 1
              ) AS d
            ) AS with_prior
            WHERE 2 * abs(total_orders - prior_day_orders) > prior_day_orders""", "pct_change", "report_date"),
        "dq_orphan_settlements": _sql("""
            SELECT settlement_id, txn_id FROM ss
            WHERE NOT EXISTS (SELECT 1 FROM sg WHERE sg.txn_id = ss.txn_id)"""),
        "dq_report": _sql(_report()),
        "raw_day_replace": _sql("""
            SELECT * FROM raw_g WHERE run_date <> DATE '2026-09-05'
            UNION ALL BY NAME
            SELECT txn_id, order_id, gateway_status, CAST(amount AS DECIMAL(12,2)) AS amount,
              strptime(event_time, '%Y-%m-%dT%H:%M:%S+00:00') AS event_time, event_type, run_date,
              TIMESTAMP '2026-09-21' AS ingested_at
            FROM judged_g WHERE reason IS NULL AND run_date = DATE '2026-09-05'""", "amount", "run_date"),
        "orders_upsert": _sql("""
            SELECT order_id, merchant_id, customer_vpa, amount,
              CASE WHEN pay_d <= 9 THEN fin_status ELSE init_status END AS status, created_at,
              CASE WHEN pay_d <= 9 THEN pay_time ELSE created_at END AS updated_at
            FROM base""", "amount"),
        "settlement_fee_check": _sql("""
            SELECT settlement_id, txn_id, order_id, gross_amount, fee_rate, mdr_fee, expected_mdr_fee,
              gst_on_fee, expected_gst_on_fee, net_settled,
              gross_amount - expected_mdr_fee - expected_gst_on_fee AS expected_net_settled
            FROM (
              SELECT ss.*, so.order_id, v.fee_rate, round(gross_amount * v.fee_rate, 2) AS expected_mdr_fee,
                round(round(gross_amount * v.fee_rate, 2) * CAST(0.18 AS DECIMAL(3,2)), 2) AS expected_gst_on_fee
              FROM ss JOIN sg USING (txn_id) JOIN so ON so.order_id = sg.order_id
              JOIN versions AS v ON v.merchant_id = so.merchant_id AND v.valid_from <= so.created_at
                AND (v.valid_to IS NULL OR so.created_at < v.valid_to)
              WHERE settlement_type = 'payment'
            ) AS rated
            WHERE mdr_fee <> expected_mdr_fee OR gst_on_fee <> expected_gst_on_fee
              OR net_settled <> gross_amount - expected_mdr_fee - expected_gst_on_fee
            """, "gross_amount fee_rate mdr_fee expected_mdr_fee gst_on_fee expected_gst_on_fee net_settled"
                 " expected_net_settled"),
        "answer_key": _sql("SELECT * FROM answers", "amount"),
        "run_log": _sql("SELECT * FROM run_steps", dates="run_date"),
        "headline_metrics": _sql("""
            SELECT metric, CAST(value AS DOUBLE) AS value FROM (
              SELECT 'payments_reconciled' AS metric, CAST(count(*) AS DOUBLE) AS value FROM fact
              UNION ALL SELECT status, coalesce(n, 0)
              FROM (SELECT unnest(['matched', 'discrepancy', 'pending', 'refunded']) AS status) AS s
              LEFT JOIN (SELECT reconciliation_status AS status, count(*) AS n FROM fact GROUP BY 1) AS f
                USING (status)
              UNION ALL SELECT 'rows_in', count(*) FROM judged
              UNION ALL SELECT 'rows_rejected', count(*) FROM judged WHERE NOT ok
              UNION ALL SELECT 'rejected_pct',
                ((20000 * count(*) FILTER (WHERE NOT ok) + count(*)) // (2 * count(*))) / 100.0 FROM judged
              UNION ALL SELECT 'avg_precision', round(avg(precision), 2) FROM scores
              UNION ALL SELECT 'avg_recall', round(avg(recall), 2) FROM scores
            ) AS m"""),
        "reconciliation_drilldown": _sql("""
            SELECT * FROM fact WHERE reconciliation_status = 'discrepancy'
              AND CAST(coalesce(order_created_at, gateway_event_time) AS DATE) BETWEEN DATE '2026-09-03' AND DATE '2026-09-07'
            """, _FACT_MONEY, _FACT_DATES),
    }
