"""SQL over the raw tables for the registered queries, for a second engine.

The text is written for a plain reading of the semantics: rates are joined to
every single account's total before summing, distinct senders are counted as
such, and messages are selected from the events without any JSON parsing.
"""

from __future__ import annotations

from paymart.queries.batch import FIRST_DAY, HUGE_AMOUNT, LARGE_AMOUNT, LAST_DAY, ONE_DAY, TABLES
from paymart.queries.stored import REPLACED_FIRST, REPLACED_LAST, REPLACED_WITH_ROWS
from paymart.schemas import STATUSES, TRANSACTION_TYPES

TXN_LIST = (
    "operation_id, account_number_from, account_number_to, currency_code, country, "
    "status, transaction_type, amount, transaction_dt"
)

TRANSACTIONS = """
SELECT CAST(o_orderkey AS VARCHAR) AS operation_id,
       CAST(IF(o_orderkey % 37 = 0, -1, o_custkey) AS INTEGER) AS account_number_from,
       CAST(IF(o_orderkey % 41 = 0, -1, (o_custkey * 7 + 13) % 1500) AS INTEGER) AS account_number_to,
       CAST(400 + 10 * (c_nationkey % 7) AS INTEGER) AS currency_code,
       'COUNTRY_' || (c_nationkey % 7) AS country,
       CASE left(o_orderpriority, 1) WHEN '1' THEN 'done' WHEN '2' THEN 'queued'
            WHEN '3' THEN 'in_progress' WHEN '4' THEN 'blocked' ELSE 'chargeback' END AS status,
       (['authorisation', 'sbp_incoming', 'sbp_outgoing', 'transfer_incoming', 'transfer_outgoing',
         'c2b_partner_incoming', 'c2b_partner_outgoing'])[o_orderkey % 7 + 1] AS transaction_type,
       CAST(round(o_totalprice * 100) AS BIGINT) AS amount,
       o_orderdate AS transaction_dt
FROM orders, customer WHERE c_custkey = o_custkey
"""

EVENTS = """
SELECT 'evt-' || event_id AS operation_id,
       CAST(user_id AS INTEGER) AS account_number_from,
       CAST((user_id * 7 + 13) % 150 AS INTEGER) AS account_number_to,
       CAST(400 + 10 * (user_id % 3) AS INTEGER) AS currency_code,
       'COUNTRY_' || (user_id % 3) AS country,
       CASE event_type WHEN 'purchase' THEN 'done' WHEN 'signup' THEN 'queued'
            WHEN 'view' THEN 'in_progress' WHEN 'error' THEN 'blocked' ELSE 'chargeback' END AS status,
       IF(event_id % 2 = 0, 'sbp_incoming', 'sbp_outgoing') AS transaction_type,
       CAST(round(value * 100) AS BIGINT) AS amount,
       ts AS transaction_dt,
       event_id, event_type
FROM events
"""

RATES = """
SELECT CAST(400 + 10 * k AS INTEGER) AS currency_code,
       CAST(w AS INTEGER) AS currency_code_with,
       d AS date_update,
       CAST(IF((k + day(d)) % 11 = 0, 0, (k * 31 + day(d) * 17) % 900 + 100)
            * CAST(0.001 AS DECIMAL(9, 6)) AS DECIMAL(18, 6)) AS currency_with_div
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(ts AS DATE) FROM events),
     (SELECT DISTINCT n_nationkey % 7 AS k FROM nation),
     (VALUES (420), (430)) quotes(w)
WHERE 400 + 10 * k <> w AND (k + month(d)) % 5 <> 0
"""

PAYLOAD = """
'{"operation_id":"' || operation_id || '","account_number_from":' || account_number_from
|| ',"account_number_to":' || account_number_to || ',"currency_code":' || currency_code
|| ',"country":"' || country || '","status":"' || status || '","transaction_type":"' || transaction_type
|| '","amount":' || amount || ',"transaction_dt":"' || strftime(transaction_dt, '%Y-%m-%d %H:%M:%S.%f') || '"}'
"""

ENVELOPE = """
'{"object_id":"' || object_id || '","object_type":"' || object_type || '","sent_dttm":"'
|| strftime(sent_dttm, '%Y-%m-%d %H:%M:%S.%f') || '","payload":"' || replace(payload, '"', '\\"') || '"}'
"""

COMMON = f"""
WITH txn AS ({TRANSACTIONS}),
     evt AS ({EVENTS}),
     rates AS ({RATES}),
     msg AS (SELECT operation_id AS object_id,
                    IF(event_type = 'purchase', 'TRANSACTION', 'CURRENCY') AS object_type,
                    transaction_dt AS sent_dttm, {PAYLOAD} AS payload, event_id
             FROM evt),
     sent AS (SELECT * FROM msg UNION ALL SELECT * FROM msg WHERE event_id % 10 = 0)
"""

STORED_EVENT = (
    f"{TXN_LIST.replace('transaction_dt', '')} date_trunc('millisecond', transaction_dt) AS transaction_dt, "
    "CAST(transaction_dt AS DATE) AS business_dt"
)


def _q(body: str) -> str:
    return COMMON + body


def _mart(
    source: str,
    by_status: bool,
    rule: str,
    rounding: str = "round_even",
    rates: str = "SELECT DISTINCT * FROM rates",
    where: str = "TRUE",
    total: str = "BIGINT",
    amounts: str = "DECIMAL(20, 0)",
    rated: str = "DECIMAL(18, 6)",
) -> str:
    """The mart as a subquery, rates joined at account level."""
    status = ", status" if by_status else ""
    rate = {
        "positive": "IF(currency_with_div > 0, currency_with_div, 1)",
        "present": "IF(currency_with_div IS NOT NULL, currency_with_div, 1)",
    }[rule]
    return f"""(
    SELECT date_update, currency_code AS currency_from,
           CAST({rounding}(sum(CAST(amount AS {amounts}) * CAST({rate} AS {rated})), 0) AS {total})
               AS amount_total,
           CAST(sum(n) AS BIGINT) AS cnt_transactions,
           {rounding}(avg(n), 0) AS avg_transactions_per_account,
           count(DISTINCT account_number_from) AS cnt_accounts_make_transactions{status}
    FROM (SELECT CAST(transaction_dt AS DATE) AS date_update, currency_code, account_number_from{status},
                 sum(amount) AS amount, count(*) AS n
          FROM {source}
          WHERE account_number_from > 0 AND account_number_to > 0 AND {where}
          GROUP BY ALL) per_account
    LEFT JOIN (SELECT date_update, currency_code, currency_with_div FROM ({rates})
               WHERE currency_code_with = 420) quoted USING (date_update, currency_code)
    GROUP BY date_update, currency_code{status})"""


MERGED = _mart("txn", False, "present")
BY_STATUS = _mart("txn", True, "positive")
EVENTS_BY_STATUS = _mart("evt", True, "positive")
NAMES = "(SELECT DISTINCT country, currency_code FROM txn)"
ONE_DAY_ONLY = f"CAST(transaction_dt AS DATE) = DATE '{ONE_DAY}'"
DAYS_ONLY = f"CAST(transaction_dt AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"
RATED = """(SELECT e.operation_id, e.currency_code, e.amount, CAST(e.transaction_dt AS DATE) AS date_update,
                   r.currency_with_div
            FROM evt e LEFT JOIN rates r ON r.date_update = CAST(e.transaction_dt AS DATE)
                 AND r.currency_code = e.currency_code AND r.currency_code_with = 420)"""
POSITIVE = "CAST(IF(currency_with_div > 0, currency_with_div, 1) AS DECIMAL(18, 6))"
PRESENT = "CAST(coalesce(currency_with_div, 1) AS DECIMAL(18, 6))"

ACTIVE = """(SELECT CAST(transaction_dt AS DATE) AS date_update, currency_code AS currency_from,
                    count(DISTINCT account_number_from) AS accounts, count(*) AS n
             FROM evt WHERE account_number_from > 0 AND account_number_to > 0 GROUP BY ALL)"""

STORED_TARGET = TXN_LIST.replace("country", "'stored' AS country").replace(
    "transaction_type", "'stored' AS transaction_type"
)

DAMAGED_TEXT = f"""(
    SELECT IF(event_type = 'signup', 'envelope', IF(event_type = 'error', 'payload', NULL)) AS reject_reason,
           IF(event_type = 'signup', '{{' || text, text) AS raw
    FROM (SELECT event_type, {ENVELOPE} AS text
          FROM (SELECT event_type, operation_id AS object_id, 'TRANSACTION' AS object_type,
                       transaction_dt AS sent_dttm,
                       IF(event_type = 'error', '{{' || whole, whole) AS payload
                FROM (SELECT *, {PAYLOAD} AS whole FROM evt))))"""


ALL_DONE = "(SELECT * REPLACE ('done' AS status) FROM evt)"
CORRECTED = """(
    SELECT * REPLACE (IF(event_id % 3 = 0, transaction_dt + INTERVAL 1 DAY, transaction_dt) AS transaction_dt,
                      IF(event_id % 4 = 0, 'chargeback', status) AS status)
    FROM evt WHERE event_type = 'purchase')"""
DOUBLED_RATES = "SELECT * REPLACE (IF(day(date_update) = 17, currency_with_div * 2, currency_with_div) AS currency_with_div) FROM rates"
TROUBLED_REJECTS = """
SELECT CASE event_id % 5 WHEN 1 THEN 'null' WHEN 2 THEN 'type' WHEN 3 THEN 'day' ELSE 'envelope' END AS reject_reason,
       count(*) AS count
FROM events WHERE event_id % 5 > 0 GROUP BY ALL
"""
LARGE = f""", large AS (
    SELECT * REPLACE (IF(operation_id = min(IF(account_number_from > 0 AND account_number_to > 0, operation_id, NULL))
                                          OVER (PARTITION BY CAST(transaction_dt AS DATE), currency_code, status),
                         {LARGE_AMOUNT} + amount, amount) AS amount) FROM evt)
"""


HUGE = f"(SELECT * REPLACE (CAST({HUGE_AMOUNT} AS HUGEINT) + amount AS amount) FROM evt)"
ANY_SUM = {"total": "DECIMAL(38, 0)", "amounts": "DECIMAL(26, 0)", "rated": "DECIMAL(12, 6)"}
DAMAGED_ORDERS = """, damaged AS (
    SELECT * REPLACE (IF(CAST(operation_id AS BIGINT) % 9 = 0, 'none', operation_id) AS operation_id,
                      IF(CAST(operation_id AS BIGINT) % 5 <> 0, country, NULL) AS country,
                      IF(CAST(operation_id AS BIGINT) % 4 = 0, 'x' || status, status) AS status,
                      amount * 100 AS amount) FROM txn)
"""


def _literals(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _profile(name: str) -> str:
    return (
        f"SELECT '{name}' AS source, (SELECT count(*) FROM {name}) AS n_rows, "
        f"(SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE {name})) AS n_columns"
    )


ORACLES: dict[str, str] = {
    # sources
    "profile_source": " UNION ALL ".join(_profile(t) for t in TABLES),
    "read_where": "SELECT * FROM orders WHERE o_totalprice > 250000 AND o_orderstatus = 'F'",
    "select_transaction_columns": _q(f"SELECT {TXN_LIST} FROM evt"),
    "run_sql_file": _q(f"SELECT * FROM {_mart('txn', True, 'positive', where=ONE_DAY_ONLY)}"),
    "preview": _q("SELECT * FROM rates ORDER BY date_update, currency_code, currency_code_with LIMIT 5"),
    # projections, filters, scalar functions
    "decode_json": "SELECT CAST(regexp_extract(props, '\"k\": ?(-?[0-9]+)', 1) AS INTEGER) AS k FROM events",
    "decode_envelope": _q(
        "SELECT object_id, object_type, sent_dttm, payload FROM sent "
        "UNION ALL SELECT NULL, NULL, NULL, NULL FROM events WHERE event_id < 3"
    ),
    "decode_payload": _q(
        f"SELECT {TXN_LIST} FROM evt UNION ALL SELECT {TXN_LIST} FROM evt WHERE event_id % 10 = 0 "
        "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_id < 3"
    ),
    "filter_message_type": _q(
        "SELECT object_id, object_type, sent_dttm, payload FROM sent WHERE object_type = 'TRANSACTION'"
    ),
    "transactions_from_messages": _q(f"SELECT {STORED_EVENT} FROM evt WHERE event_type = 'purchase'"),
    "filter_real_accounts": _q("SELECT * FROM txn WHERE account_number_from > 0 AND account_number_to > 0"),
    "filter_business_day": _q(f"SELECT * FROM txn WHERE {ONE_DAY_ONLY}"),
    "filter_days": _q(f"SELECT * FROM txn WHERE {DAYS_ONLY}"),
    "filter_quote_currency": _q(
        "SELECT currency_code, date_update, currency_with_div FROM rates WHERE currency_code_with = 420"
    ),
    "rate_positive_else_one": _q(f"SELECT *, {POSITIVE} AS rate FROM {RATED}"),
    "rate_coalesce_one": _q(f"SELECT *, {PRESENT} AS rate FROM {RATED}"),
    "convert_amount": _q(
        f"SELECT operation_id, CAST(CAST(amount AS DECIMAL(18, 0)) * {POSITIVE} AS DECIMAL(38, 6)) AS converted "
        f"FROM {RATED}"
    ),
    "round_total": _q(
        "SELECT operation_id, CAST(round_even(x, 0) AS BIGINT) AS half_even, CAST(round(x, 0) AS BIGINT) AS half_up "
        f"FROM (SELECT operation_id, CAST(CAST(amount AS DECIMAL(18, 0)) * {POSITIVE} AS DOUBLE) / 8 AS x FROM {RATED})"
    ),
    "round_average": _q(
        "SELECT operation_id, round_even(amount / 8, 0) AS half_even, round(amount / 8, 0) AS half_up FROM evt"
    ),
    "business_day": _q(
        "SELECT operation_id, CAST(transaction_dt AS DATE) AS day, "
        "CAST(date_trunc('day', transaction_dt) AS TIMESTAMP) AS midnight FROM evt"
    ),
    "currency_label": _q("SELECT operation_id, country || ' | cur' AS currency_name FROM txn"),
    "encode_json": _q(f"SELECT operation_id, {PAYLOAD} AS payload FROM evt"),
    "encode_messages": _q(
        f"SELECT {ENVELOPE} AS value FROM (SELECT * REPLACE ('TRANSACTION' AS object_type) FROM msg)"
    ),
    "to_target_columns": _q("SELECT currency_code, currency_code_with, date_update, currency_with_div FROM rates"),
    "conform_transaction": _q(f"SELECT {STORED_EVENT} FROM evt"),
    "conform_rate": _q("SELECT * FROM rates"),
    # joins
    "join_rates": _q(
        "SELECT t.*, r.currency_with_div FROM (SELECT CAST(transaction_dt AS DATE) AS date_update, currency_code, "
        "status, account_number_from, CAST(sum(amount) AS BIGINT) AS amount_total, count(*) AS cnt_usr_transactions "
        "FROM txn WHERE account_number_from > 0 AND account_number_to > 0 GROUP BY ALL) t LEFT JOIN rates r "
        "ON r.date_update = t.date_update AND r.currency_code = t.currency_code AND r.currency_code_with = 420"
    ),
    "join_currency_names": _q(
        f"SELECT m.*, n.country || ' | cur' AS currency_name FROM {MERGED} m "
        f"JOIN {NAMES} n ON n.currency_code = m.currency_from"
    ),
    "new_rows": _q(f"SELECT {TXN_LIST} FROM evt WHERE status <> 'done'"),
    # aggregates
    "account_day_totals": _q(
        "SELECT CAST(transaction_dt AS DATE) AS date_update, currency_code, account_number_from, "
        "CAST(sum(amount) AS BIGINT) AS amount_total, count(*) AS cnt_usr_transactions FROM evt "
        "WHERE account_number_from > 0 AND account_number_to > 0 GROUP BY ALL"
    ),
    "account_day_status_totals": _q(
        "SELECT CAST(transaction_dt AS DATE) AS date_update, currency_code, status, account_number_from, "
        "CAST(sum(amount) AS BIGINT) AS amount_total, count(*) AS cnt_usr_transactions FROM evt "
        "WHERE account_number_from > 0 AND account_number_to > 0 GROUP BY ALL"
    ),
    "global_metrics": _q(f"SELECT * FROM {MERGED}"),
    "global_metrics_by_status": _q(f"SELECT * FROM {BY_STATUS}"),
    "global_metrics_of_events": _q(f"SELECT * FROM {_mart('evt', False, 'present')}"),
    "global_metrics_by_status_of_events": _q(f"SELECT * FROM {_mart('evt', True, 'positive', 'round')}"),
    "global_metrics_fan_out": _q(
        "SELECT * FROM "
        + _mart(
            "evt",
            True,
            "positive",
            rates="SELECT * FROM rates UNION ALL SELECT * FROM rates UNION ALL "
            "SELECT * REPLACE (currency_with_div * 2 AS currency_with_div) FROM rates",
        )
    ),
    "currency_names": _q(f"SELECT * FROM {NAMES}"),
    "dedupe_rates": _q("SELECT * FROM rates"),
    "metrics_for_day": _q(f"SELECT * FROM {_mart('txn', True, 'positive', where=ONE_DAY_ONLY)}"),
    "metrics_backfill": _q(f"SELECT * FROM {_mart('txn', True, 'positive', where=DAYS_ONLY)}"),
    "metrics_ordered": _q(f"SELECT * FROM {_mart('evt', False, 'present')} ORDER BY date_update, currency_from"),
    # dashboard
    "dashboard_source": _q(
        "SELECT date_update, currency_from, country || ' | cur' AS currency_name, amount_total, cnt_transactions, "
        f"avg_transactions_per_account, cnt_accounts_make_transactions FROM {MERGED} m "
        f"JOIN {NAMES} n ON n.currency_code = m.currency_from"
    ),
    "turnover_by_currency": _q(
        f"SELECT date_update, currency_from, CAST(sum(amount_total) AS BIGINT) AS turnover FROM {BY_STATUS} GROUP BY ALL"
    ),
    "active_accounts_by_currency": _q(
        f"SELECT date_update, currency_from, accounts AS active_accounts FROM {ACTIVE}"
    ),
    "avg_transactions_per_account": _q(
        f"SELECT date_update, currency_from, n / accounts AS avg_transactions FROM {ACTIVE}"
    ),
    "company_turnover": _q(
        f"SELECT date_update, CAST(sum(amount_total) AS BIGINT) AS turnover FROM {BY_STATUS} GROUP BY ALL"
    ),
    # dedup and upserts
    "dedup_by_id": _q(
        "SELECT object_id, object_type, sent_dttm, payload FROM msg UNION ALL SELECT NULL, NULL, NULL, NULL"
    ),
    "upsert_do_nothing": _q(
        f"SELECT {STORED_TARGET} FROM evt WHERE status = 'done' "
        f"UNION ALL SELECT {TXN_LIST} FROM evt WHERE status <> 'done'"
    ),
    "upsert_do_update": _q(f"SELECT {TXN_LIST} FROM evt"),
    "upsert_do_update_some_columns": _q(
        f"SELECT {TXN_LIST} FROM (SELECT * REPLACE (IF(status = 'done', 'stored', NULL) AS country, "
        "IF(transaction_type = 'sbp_incoming', transaction_type, NULL) AS transaction_type) FROM evt)"
    ),
    # checks
    "require_rows": _q(f"SELECT {TXN_LIST} FROM evt"),
    "not_null_report": _q(
        " UNION ALL ".join(
            f"SELECT '{c.strip()}' AS column_name, count(*) AS null_count FROM events "
            "WHERE event_type IN ('error', 'signup')"
            for c in TXN_LIST.split(",")
        )
    ),
    "unique_key_report": _q(
        "SELECT object_type, object_id, CAST(2 AS BIGINT) AS row_count FROM msg WHERE event_id % 10 = 0 "
        "UNION ALL SELECT NULL, NULL, count(*) FROM events WHERE event_id < 3"
    ),
    "unique_rate_key_report": _q(
        "SELECT currency_code, currency_code_with, date_update, CAST(2 AS BIGINT) AS row_count FROM rates "
        "WHERE currency_with_div <> 0"
    ),
    "domain_report": _q(
        "SELECT 'status' AS column_name, event_type AS bad_value, count(*) AS row_count FROM events "
        f"WHERE event_type NOT IN ({_literals(STATUSES)}) GROUP BY ALL UNION ALL "
        "SELECT 'transaction_type', 'sbp_' || event_type, count(*) FROM events "
        f"WHERE 'sbp_' || event_type NOT IN ({_literals(TRANSACTION_TYPES)}) GROUP BY ALL"
    ),
    "quarantine": _q(f"SELECT * FROM {DAMAGED_TEXT} WHERE reject_reason IS NOT NULL"),
    "quarantine_passed": _q(f"SELECT {TXN_LIST} FROM evt WHERE event_type NOT IN ('signup', 'error')"),
    "int_range_report": _q(
        "SELECT 'amount' AS column_name, count(*) AS out_of_range, min(amount * 100) AS lowest, "
        "max(amount * 100) AS highest FROM txn WHERE amount * 100 NOT BETWEEN -2147483648 AND 2147483647 "
        "UNION ALL SELECT 'account_number_from', 0, NULL, NULL UNION ALL SELECT 'currency_code', 0, NULL, NULL"
    ),
    "missing_rate_report": _q(
        "SELECT t.date_update, t.currency_code, count(*) AS cnt_transactions FROM "
        "(SELECT *, CAST(transaction_dt AS DATE) AS date_update FROM txn) t "
        "WHERE account_number_from > 0 AND account_number_to > 0 AND currency_code <> 420 AND NOT EXISTS "
        "(SELECT 1 FROM rates r WHERE r.currency_code_with = 420 AND r.currency_with_div > 0 "
        "AND r.date_update = t.date_update AND r.currency_code = t.currency_code) GROUP BY ALL"
    ),
    "account_day_totals_any_sum": _q(
        "SELECT CAST(transaction_dt AS DATE) AS date_update, currency_code, account_number_from, "
        f"CAST(sum(amount) AS DECIMAL(30, 0)) AS amount_total, count(*) AS cnt_usr_transactions FROM {HUGE} "
        "WHERE account_number_from > 0 AND account_number_to > 0 GROUP BY ALL"
    ),
    "global_metrics_any_sum": _q(f"SELECT * FROM {_mart(HUGE, False, 'present', **ANY_SUM)}"),
    "global_metrics_by_status_any_sum": _q(f"SELECT * FROM {_mart(HUGE, True, 'positive', **ANY_SUM)}"),
    "load_facts": COMMON + DAMAGED_ORDERS + " UNION ALL ".join(
        [
            *[
                f"SELECT 'null' AS report, '{c.strip()}' AS name, NULL AS value, "
                f"count(*) - count({c.strip()}) AS row_count, "
                "CAST(NULL AS BIGINT) AS lowest, CAST(NULL AS BIGINT) AS highest FROM damaged"
                for c in TXN_LIST.split(",")
            ],
            "SELECT 'domain', 'status', status, count(*), NULL, NULL FROM damaged WHERE status LIKE 'x%' GROUP BY ALL",
            "SELECT 'range', 'amount', NULL, count(*), min(amount), max(amount) FROM damaged "
            "WHERE amount NOT BETWEEN -2147483648 AND 2147483647",
            "SELECT 'key', 'operation_id', operation_id, count(*), NULL, NULL FROM damaged GROUP BY ALL HAVING count(*) > 1",
            "SELECT 'rate', 'cell', CAST(t.date_update AS VARCHAR) || ' ' || t.currency_code, count(*), NULL, NULL FROM "
            "(SELECT *, CAST(transaction_dt AS DATE) AS date_update FROM damaged) t "
            "WHERE account_number_from > 0 AND account_number_to > 0 AND currency_code <> 420 AND NOT EXISTS "
            "(SELECT 1 FROM rates r WHERE r.currency_code_with = 420 AND r.currency_with_div > 0 "
            "AND r.date_update = t.date_update AND r.currency_code = t.currency_code) GROUP BY ALL",
        ]
    ),
    # written and read back
    "compact_days": _q(f"SELECT {STORED_EVENT} FROM evt"),
    "replace_days_at_once": _q(
        f"SELECT * FROM {EVENTS_BY_STATUS} WHERE date_update BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' "
        f"AND (date_update < DATE '{REPLACED_FIRST}' OR date_update > DATE '{REPLACED_LAST}' "
        f"OR (status = 'done' AND date_update <= DATE '{REPLACED_WITH_ROWS}'))"
    ),
    "bucketed_account_totals": _q(
        "SELECT CAST(transaction_dt AS DATE) AS date_update, currency_code, account_number_from, "
        "CAST(sum(amount) AS BIGINT) AS amount_total, count(*) AS cnt_usr_transactions FROM evt "
        "WHERE account_number_from > 0 AND account_number_to > 0 GROUP BY ALL"
    ),
    "read_messages_batch": _q(
        f"SELECT {ENVELOPE} AS value FROM sent UNION ALL SELECT 'not json' FROM events WHERE event_id < 3"
    ),
    "produce_messages": _q(
        f"SELECT {ENVELOPE} AS value FROM (SELECT * REPLACE ('TRANSACTION' AS object_type) FROM msg)"
    ),
    "replay_table_to_topic": _q(f"SELECT {STORED_EVENT} FROM evt"),
    "read_rates_csv": _q("SELECT * FROM rates"),
    "load_rates": _q("SELECT * FROM rates"),
    "append_transactions": _q(f"SELECT {STORED_EVENT} FROM evt UNION ALL SELECT {STORED_EVENT} FROM evt"),
    "write_count": "SELECT count(*) AS rows_written FROM events",
    "append_metrics": _q(f"SELECT * FROM {EVENTS_BY_STATUS}"),
    "replace_days": _q(
        f"SELECT * FROM {EVENTS_BY_STATUS} WHERE date_update < DATE '{REPLACED_FIRST}' "
        f"OR date_update > DATE '{REPLACED_LAST}' OR (status = 'done' AND date_update <= DATE '{REPLACED_WITH_ROWS}')"
    ),
    "update_mart": _q(
        "SELECT * FROM "
        + _mart(
            "evt",
            True,
            "positive",
            where="CAST(transaction_dt AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'",
        )
    ),
    "insert_new": _q(
        f"SELECT {STORED_EVENT} FROM (SELECT * REPLACE (IF(status = 'done', 'stored', country) AS country) FROM evt)"
    ),
    "insert_or_update": _q(f"SELECT {STORED_EVENT} FROM evt"),
    "ingest_messages": _q(f"SELECT {STORED_EVENT} FROM evt WHERE event_type = 'purchase'"),
    "ingest_moved_messages": _q(f"SELECT {STORED_EVENT} FROM {CORRECTED}"),
    "update_changed_days": _q(f"SELECT * FROM {_mart(CORRECTED, True, 'positive', rates=DOUBLED_RATES)}"),
    "ingest_rejects": _q(f"SELECT * FROM {DAMAGED_TEXT} WHERE reject_reason IS NOT NULL"),
    "ingest_troubled_messages": _q(f"SELECT {STORED_EVENT} FROM {ALL_DONE} UNION ALL SELECT {STORED_EVENT} FROM {ALL_DONE}"),
    "ingest_troubled_rejects": TROUBLED_REJECTS,
    "quarantine_troubled": f"SELECT * FROM ({TROUBLED_REJECTS}) WHERE reject_reason IN ('envelope', 'type')",
    "stream_upsert_troubled": _q(f"SELECT {STORED_EVENT} FROM {ALL_DONE}"),
    "read_rates_csv_by_name": _q("SELECT * FROM rates"),
    "ingest_rate_rejects": _q(
        "SELECT currency_with_div <> 0 AS is_loaded, currency_code || ',' || currency_code_with || ',' || date_update || ',' "
        "|| IF(currency_with_div = 0, 'none', CAST(currency_with_div AS VARCHAR)) AS line FROM rates"
    ),
    "moved_operations": _q(
        "SELECT operation_id, CAST(2 AS BIGINT) AS row_count FROM evt WHERE event_id % 7 = 0"
    ),
    "sync_catalogue": _q(f"SELECT * FROM {EVENTS_BY_STATUS}"),
    "global_metrics_large_amounts": COMMON + LARGE + f"SELECT * FROM {_mart('large', True, 'positive')}",
    "stream_dedup_global_far_times": _q("SELECT object_id, object_type, payload FROM msg UNION ALL SELECT NULL, NULL, NULL"),
    "stream_dedup_bounded_far_times": _q("SELECT object_id, object_type, payload FROM msg UNION ALL SELECT NULL, NULL, NULL"),
    "create_tables": _q(f"SELECT * FROM {_mart('evt', False, 'present')}"),
    # streams
    "read_messages_stream": _q(
        f"SELECT {ENVELOPE} AS value FROM sent UNION ALL SELECT 'not json' FROM events WHERE event_id < 3"
    ),
    "stream_decode": _q(
        f"SELECT {STORED_EVENT} FROM evt WHERE event_type = 'purchase' UNION ALL "
        f"SELECT {STORED_EVENT} FROM evt WHERE event_type = 'purchase' AND event_id % 10 = 0"
    ),
    "watermark_60m": _q(
        "SELECT object_id, object_type, sent_dttm, payload FROM sent "
        "UNION ALL SELECT NULL, NULL, NULL, NULL FROM events WHERE event_id < 3"
    ),
    "stream_dedup_global": _q(
        "SELECT object_id, object_type, sent_dttm, payload FROM msg UNION ALL SELECT NULL, NULL, NULL, NULL"
    ),
    "stream_dedup_bounded": _q(
        "SELECT object_id, object_type, sent_dttm, payload FROM msg UNION ALL SELECT NULL, NULL, NULL, NULL"
    ),
    "stream_upsert": _q(f"SELECT {STORED_EVENT} FROM evt WHERE event_type = 'purchase'"),
}
