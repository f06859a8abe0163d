"""Column layouts and fixed values of the payments domain."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# They have to be equal to what producers and dashboards already use.

MESSAGE_TYPE = "TRANSACTION"
QUOTE_CURRENCY = 420
LABEL_SUFFIX = " | cur"
EVENT_TIME = "sent_dttm"
EVENT_TIME_DELAY = "60 minutes"

STATUSES = ["queued", "in_progress", "blocked", "done", "chargeback"]

TRANSACTION_TYPES = [
    "authorisation",
    "sbp_incoming",
    "sbp_outgoing",
    "transfer_incoming",
    "transfer_outgoing",
    "c2b_partner_incoming",
    "c2b_partner_outgoing",
]

INT32_MIN = -2147483648
INT32_MAX = 2147483647

# Text form of times inside JSON messages.
JSON_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# --- Schemas ----------------------------------------------------------------

ENVELOPE = T.StructType(
    [
        T.StructField("object_id", T.StringType()),
        T.StructField("object_type", T.StringType()),
        T.StructField("sent_dttm", T.TimestampType()),
        T.StructField("payload", T.StringType()),
    ]
)

# ``amount`` is read as BIGINT: read as INT, a value above the 32-bit range
# would turn into NULL without a trace. ``int_range_report`` finds such values.
TRANSACTION = T.StructType(
    [
        T.StructField("operation_id", T.StringType()),
        T.StructField("account_number_from", T.IntegerType()),
        T.StructField("account_number_to", T.IntegerType()),
        T.StructField("currency_code", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("transaction_dt", T.TimestampType()),
    ]
)
TXN_COLUMNS = TRANSACTION.fieldNames()

# A stored transaction carries its day as the partition column.
TXN_DAY = "business_dt"
TRANSACTION_TABLE = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType() if f.name == "transaction_dt" else f.dataType)
        for f in TRANSACTION
    ]
    + [T.StructField(TXN_DAY, T.DateType())]
)
TXN_KEY = [TXN_DAY, "operation_id"]

RATES = T.StructType(
    [
        T.StructField("currency_code", T.IntegerType()),
        T.StructField("currency_code_with", T.IntegerType()),
        T.StructField("date_update", T.DateType()),
        T.StructField("currency_with_div", T.DecimalType(18, 6)),
    ]
)
RATE_KEY = ["currency_code", "currency_code_with", "date_update"]

METRICS = T.StructType(
    [
        T.StructField("date_update", T.DateType()),
        T.StructField("currency_from", T.IntegerType()),
        T.StructField("amount_total", T.LongType()),
        T.StructField("cnt_transactions", T.LongType()),
        T.StructField("avg_transactions_per_account", T.DoubleType()),
        T.StructField("cnt_accounts_make_transactions", T.LongType()),
    ]
)
METRICS_DAY = "date_update"
METRICS_BY_STATUS = T.StructType(METRICS.fields + [T.StructField("status", T.StringType())])

# The same with totals that hold any sum of BIGINT amounts.
METRICS_WIDE = T.StructType(
    [T.StructField(f.name, T.DecimalType(38, 0)) if f.name == "amount_total" else f for f in METRICS]
)
METRICS_BY_STATUS_WIDE = T.StructType(METRICS_WIDE.fields + [T.StructField("status", T.StringType())])

CURRENCY_NAMES = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("currency_code", T.IntegerType()),
    ]
)
