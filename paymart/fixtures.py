"""Payments data derived from the given tables.

Nothing here is made up: every row comes from ``orders``, ``customer``,
``events`` or ``nation``, so it grows with them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.functions.messages import encode_json
from paymart.schemas import JSON_TIME, TXN_COLUMNS

# Source value -> status, in the order they are tested.
ORDER_STATUS = {
    "1-URGENT": "done",
    "2-HIGH": "queued",
    "3-MEDIUM": "in_progress",
    "4-NOT SPECIFIED": "blocked",
}
EVENT_STATUS = {
    "purchase": "done",
    "signup": "queued",
    "view": "in_progress",
    "error": "blocked",
}
ORDER_TYPES = [
    "authorisation",
    "sbp_incoming",
    "sbp_outgoing",
    "transfer_incoming",
    "transfer_outgoing",
    "c2b_partner_incoming",
    "c2b_partner_outgoing",
]


# Layouts of the given tables that payments are derived from. Stated, they
# save one job per read that would look them up in the files.
LAYOUTS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(LAYOUTS[name]) if name in LAYOUTS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(column: str, mapping: dict[str, str], otherwise: str):
    case = F
    for value, result in mapping.items():
        case = case.when(F.col(column) == value, result)
    return case.otherwise(otherwise)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order; times are midnights."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    nation = F.col("c_nationkey") % 7
    types = F.array(*[F.lit(t) for t in ORDER_TYPES])
    return joined.select(
        F.col("o_orderkey").cast("string").alias("operation_id"),
        F.when(F.col("o_orderkey") % 37 == 0, -1)
        .otherwise(F.col("o_custkey"))
        .cast("int")
        .alias("account_number_from"),
        F.when(F.col("o_orderkey") % 41 == 0, -1)
        .otherwise((F.col("o_custkey") * 7 + 13) % 1500)
        .cast("int")
        .alias("account_number_to"),
        (nation * 10 + 400).cast("int").alias("currency_code"),
        F.concat(F.lit("COUNTRY_"), nation.cast("string")).alias("country"),
        _mapped("o_orderpriority", ORDER_STATUS, "chargeback").alias("status"),
        F.get(types, (F.col("o_orderkey") % 7).cast("int")).alias("transaction_type"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount"),
        F.col("o_orderdate").alias("transaction_dt"),
    )


def from_events(events: DataFrame) -> DataFrame:
    """One transaction per event, next to the event's own columns."""
    nation = F.col("user_id") % 3
    return events.select(
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("operation_id"),
        F.col("user_id").cast("int").alias("account_number_from"),
        ((F.col("user_id") * 7 + 13) % 150).cast("int").alias("account_number_to"),
        (nation * 10 + 400).cast("int").alias("currency_code"),
        F.concat(F.lit("COUNTRY_"), nation.cast("string")).alias("country"),
        _mapped("event_type", EVENT_STATUS, "chargeback").alias("status"),
        F.when(F.col("event_id") % 2 == 0, "sbp_incoming").otherwise("sbp_outgoing").alias("transaction_type"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount"),
        F.col("ts").alias("transaction_dt"),
        "event_id",
        "event_type",
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event; several per account and day."""
    return from_events(table(spark, sf_dir, "events")).select(*TXN_COLUMNS)


def currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rates of seven codes against two; some days missing, some zero."""
    days = reduce(
        DataFrame.union,
        [
            table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")),
            table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")),
        ],
    ).distinct()
    # Nation keys modulo seven are the numbers 0 to 6 at every scale.
    coded = days.select("d", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("k")).select(
        "d", "k", F.explode(F.array(F.lit(420), F.lit(430))).alias("w")
    )
    day = F.dayofmonth("d")
    thousandths = F.when((F.col("k") + day) % 11 == 0, 0).otherwise((F.col("k") * 31 + day * 17) % 900 + 100)
    return coded.where(
        (F.col("k") * 10 + 400 != F.col("w")) & ((F.col("k") + F.month("d")) % 5 != 0)
    ).select(
        (F.col("k") * 10 + 400).alias("currency_code"),
        F.col("w").alias("currency_code_with"),
        F.col("d").alias("date_update"),
        (thousandths.cast("decimal(9,0)") * F.lit("0.001").cast("decimal(9,6)"))
        .cast("decimal(18,6)")
        .alias("currency_with_div"),
    )


def messages_from(events: DataFrame, damaged: bool = False) -> DataFrame:
    """Events as topic messages; works on a batch and on a stream.

    Purchases are transactions, the rest messages of another type. Every tenth
    message is sent twice, and three texts are not JSON. With ``damaged`` set,
    all messages are transactions; those of errors have a payload with one brace too
    many before it, those of signups such an envelope.
    """
    payloads = encode_json(from_events(events), TXN_COLUMNS)
    payload = F.col("payload")
    kind = F.when(F.col("event_type") == "purchase", "TRANSACTION").otherwise("CURRENCY")
    if damaged:
        payload = _broken("payload", F.col("event_type") == "error")
        kind = F.lit("TRANSACTION")
    wrapped = encode_json(
        payloads.select(
            "event_id",
            "event_type",
            F.col("operation_id").alias("object_id"),
            kind.alias("object_type"),
            F.col("transaction_dt").alias("sent_dttm"),
            payload.alias("payload"),
        ),
        ["object_id", "object_type", "sent_dttm", "payload"],
        "text",
    )
    text = F.col("text")
    if damaged:
        text = _broken("text", F.col("event_type") == "signup")
        return wrapped.select(text.cast("binary").alias("value"))
    again = F.when(F.col("event_id") % 10 == 0, text)
    broken = F.when(F.col("event_id") < 3, F.lit("not json"))
    copies = F.explode(F.array_compact(F.array(text, again, broken)))
    return wrapped.select(copies.alias("text")).select(F.col("text").cast("binary").alias("value"))


def _broken(column: str, where: Column) -> Column:
    """The whole text, no longer JSON where the condition holds."""
    return F.when(where, F.concat(F.lit("{"), F.col(column))).otherwise(F.col(column))


def messages(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    return messages_from(table(spark, sf_dir, "events"), damaged)


def message_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The same messages as an unbounded read of the events table's files."""
    reader = spark.readStream.schema(LAYOUTS["events"])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # As a pattern the path may be one file or a folder of files; a streaming
    # read takes a plain path for a folder.
    return messages_from(reader.parquet(f"{sf_dir}/events.parque[t]"))


def troubled_messages(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Every event as a transaction, together with copies that make trouble.

    Each message first with the status ``queued``, sent an hour early. Then, by
    event_id modulo 5: 0: only the right one; 1: after it a copy without
    amount; 2: after it a copy of which the envelope has no type; 3: after it a
    copy with an implausible day; 4: after it a copy that is not JSON. Those
    come last and must not win.
    """
    if stream:
        events = spark.readStream.schema(LAYOUTS["events"]).parquet(f"{sf_dir}/events.parque[t]")
    else:
        events = table(spark, sf_dir, "events")
    rows = from_events(events).withColumn("status", F.lit("done"))
    hour = F.expr("INTERVAL 1 HOUR")

    def sent(rows: DataFrame, shift, kind=F.lit("TRANSACTION")) -> Column:
        fields = [F.date_format(c, JSON_TIME).alias(c) if c == "transaction_dt" else F.col(c) for c in TXN_COLUMNS]
        return F.to_json(
            F.struct(
                F.col("operation_id").alias("object_id"),
                kind.alias("object_type"),
                F.date_format(F.col("ts") + shift if shift is not None else F.col("ts"), JSON_TIME).alias("sent_dttm"),
                F.to_json(F.struct(*fields)).alias("payload"),
            )
        )

    rows = rows.withColumn("ts", F.col("transaction_dt"))
    early = rows.withColumn("status", F.lit("queued"))
    case = F.col("event_id") % 5
    texts = [
        early.select("event_id", sent(early, -hour).alias("text")),
        rows.select("event_id", sent(rows, None).alias("text")),
    ]
    no_amount = rows.where(case == 1).withColumn("amount", F.lit(None).cast("bigint"))
    no_type = rows.where(case == 2)
    no_day = rows.where(case == 3).withColumn("transaction_dt", F.lit("9999-12-31 10:00:00").cast("timestamp_ntz"))
    texts += [
        no_amount.select("event_id", sent(no_amount, hour).alias("text")),
        no_type.select("event_id", sent(no_type, hour, F.lit(None).cast("string")).alias("text")),
        no_day.select("event_id", sent(no_day, hour).alias("text")),
        rows.where(case == 4).select("event_id", F.concat(F.lit("{"), sent(rows, hour)).alias("text")),
    ]
    return reduce(DataFrame.unionByName, texts).select(F.col("text").cast("binary").alias("value"))


def corrected_messages(spark: SparkSession, sf_dir: str, moved: int = 3, changed: int = 4) -> DataFrame:
    """Copies that are sent an hour later: a third of the purchases on the day after, some with another status.

    Operations whose number is divisible by ``moved`` come with the next day,
    those divisible by ``changed`` with the status ``chargeback``.
    """
    rows = from_events(table(spark, sf_dir, "events").where("event_type = 'purchase'"))
    rows = rows.where((F.col("event_id") % moved == 0) | (F.col("event_id") % changed == 0))
    sent = F.date_format(F.col("transaction_dt") + F.expr("INTERVAL 1 HOUR"), JSON_TIME)
    day = F.when(F.col("event_id") % moved == 0, F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    status = F.when(F.col("event_id") % changed == 0, "chargeback").otherwise(F.col("status"))
    later = rows.withColumn("sent_dttm", sent).withColumn("transaction_dt", F.col("transaction_dt") + day).withColumn("status", status)
    enveloped = encode_json(later, TXN_COLUMNS).select(
        F.col("operation_id").alias("object_id"), F.lit("TRANSACTION").alias("object_type"), "sent_dttm", "payload"
    )
    return enveloped.select(F.to_json(F.struct("*")).cast("binary").alias("value"))
