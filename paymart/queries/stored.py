"""Queries that write to files or tables and read back what is stored."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart import fixtures, functions
from paymart.operators import totals
from paymart.plans import ingest, mart
from paymart.queries.shaping import as_text, registry
from paymart.schemas import (
    METRICS,
    METRICS_BY_STATUS,
    METRICS_DAY,
    RATES,
    TRANSACTION_TABLE,
    TXN_DAY,
)
from paymart.session import scratch_path
from paymart.sinks import bucketed, compaction, key_index, switched, tables, topics
from paymart.sources.rates import good_rates, read_rates_csv as read_csv
from paymart.sources.topics import read_messages_batch as read_batch

QUERIES, register = registry()

# Days of the stored mart that ``replace_days`` is asked for; of these, the
# ones up to the third date get new rows.
REPLACED_FIRST = "2024-01-10"
REPLACED_LAST = "2024-01-20"
REPLACED_WITH_ROWS = "2024-01-15"


def _conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return functions.conform_transaction(fixtures.event_transactions(spark, sf_dir))


def _mart(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    return mart.global_metrics_by_status(
        fixtures.event_transactions(spark, sf_dir), fixtures.currencies(spark, sf_dir), **options
    )


@register
def read_messages_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "topic")
    topics.produce_messages(fixtures.messages(spark, sf_dir), {"path": path}, format="parquet")
    return as_text(read_batch(spark, {"path": path}, format="parquet"))


@register
def produce_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "topic")
    made = functions.encode_messages(fixtures.event_transactions(spark, sf_dir))
    topics.produce_messages(made, {"path": path}, format="parquet")
    return as_text(read_batch(spark, {"path": path}, format="parquet"))


@register
def replay_table_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "topic")
    topics.replay_table_to_topic(fixtures.event_transactions(spark, sf_dir), {"path": path}, format="parquet")
    return ingest.transactions_from_messages(read_batch(spark, {"path": path}, format="parquet"))


@register
def read_rates_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    fixtures.currencies(spark, sf_dir).select(*RATES.fieldNames()).write.option("header", True).csv(path)
    return good_rates(read_csv(spark, path))


@register
def load_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv, first, second = (scratch_path(spark, name) for name in ("csv", "rates", "rates"))
    fixtures.currencies(spark, sf_dir).select(*RATES.fieldNames()).write.option("header", True).csv(csv)
    for _ in range(2):
        ingest.ingest_rates(spark, csv, first, second)
    return tables.read_rates(spark, second)


@register
def read_rates_csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file's columns stand in another order, with one more among them."""
    path = scratch_path(spark, "csv")
    rates = fixtures.currencies(spark, sf_dir).select(
        "date_update", "currency_code_with", F.lit("x").alias("remark"), "currency_with_div", "currency_code"
    )
    rates.write.option("header", True).csv(path)
    return good_rates(read_csv(spark, path))


@register
def ingest_rate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a rate of zero are broken on the way; they are kept as text."""
    csv, target, rejects = (scratch_path(spark, name) for name in ("csv", "rates", "rejects"))
    rates = fixtures.currencies(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in RATES.fieldNames()])
    broken = F.when(F.col("currency_with_div") == "0.000000", "none").otherwise(F.col("currency_with_div"))
    rates.withColumn("currency_with_div", broken).write.option("header", True).csv(csv)
    ingest.ingest_rates(spark, csv, target, rejects_path=rejects, most_bad=0.5)
    lines = spark.read.schema("line STRING").parquet(rejects).select(F.lit(False).alias("is_loaded"), "line")
    loaded = tables.read_rates(spark, target).select(F.lit(True).alias("is_loaded"), F.concat_ws(",", *RATES.fieldNames()).alias("line"))
    return loaded.unionByName(lines)


@register
def append_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = scratch_path(spark, "transactions"), scratch_path(spark, "transactions")
    tables.append_transactions(_conformed(spark, sf_dir), first, second)
    stored = [tables.read_table(spark, p, TRANSACTION_TABLE) for p in (first, second)]
    return stored[0].unionByName(stored[1])


@register
def write_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    [n] = tables.append_transactions(_conformed(spark, sf_dir), scratch_path(spark, "transactions"))
    return spark.range(1).select(F.lit(n).cast("bigint").alias("rows_written"))


@register
def append_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    tables.append_metrics(_mart(spark, sf_dir), path)
    return tables.read_table(spark, path, METRICS_BY_STATUS)


@register
def replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole mart, then some of its days replaced, twice, by fewer rows.

    The new rows are those of one status, and none for the last of the days:
    these come out empty.
    """
    path = scratch_path(spark, "metrics")
    whole = _mart(spark, sf_dir)
    tables.append_metrics(whole, path)
    fewer = whole.where(f"status = 'done' AND date_update <= '{REPLACED_WITH_ROWS}'")
    for _ in range(2):
        tables.replace_days(fewer, path, REPLACED_FIRST, REPLACED_LAST)
    return tables.read_table(spark, path, METRICS_BY_STATUS)


@register
def update_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored transactions and rates to the stored mart of the events' month."""
    transactions, rates, metrics = (scratch_path(spark, n) for n in ("transactions", "rates", "metrics"))
    tables.append_transactions(_conformed(spark, sf_dir), transactions)
    tables.load_rates(fixtures.currencies(spark, sf_dir), rates)
    ingest.update_mart(spark, transactions, rates, metrics, "2024-01-01", "2024-01-31")
    return tables.read_table(spark, metrics, METRICS_BY_STATUS)


@register
def ingest_moved_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies change the day; the first ones come once more after them. Each operation is stored once."""
    path = scratch_path(spark, "transactions")
    for messages in (fixtures.messages, fixtures.corrected_messages, fixtures.messages):
        ingest.ingest_messages(messages(spark, sf_dir), path)
    return tables.read_table(spark, path, TRANSACTION_TABLE)


@register
def update_changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart, then corrected messages for old days and some other rates; the update takes what changed."""
    transactions, csv, other, rates, metrics = (
        scratch_path(spark, n) for n in ("transactions", "csv", "csv", "rates", "metrics")
    )
    first = fixtures.currencies(spark, sf_dir).select(*RATES.fieldNames())
    first.write.option("header", True).csv(csv)
    ingest.ingest_rates(spark, csv, rates)
    ingest.ingest_messages(fixtures.messages(spark, sf_dir), transactions)
    ingest.update_mart(spark, transactions, rates, metrics)
    ingest.ingest_messages(fixtures.corrected_messages(spark, sf_dir), transactions)
    doubled = F.when(F.dayofmonth("date_update") == 17, F.col("currency_with_div") * 2).otherwise(F.col("currency_with_div"))
    first.withColumn("currency_with_div", doubled.cast("decimal(18,6)")).write.option("header", True).csv(other)
    ingest.ingest_rates(spark, other, rates)
    ingest.update_mart(spark, transactions, rates, metrics)
    return tables.read_table(spark, metrics, METRICS_BY_STATUS)


def _stored_purchases(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "transactions")
    conformed = _conformed(spark, sf_dir)
    purchases = conformed.where("status = 'done'").withColumn("country", F.lit("stored"))
    tables.append_transactions(purchases, path)
    return path, conformed


@register
def insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = _stored_purchases(spark, sf_dir)
    for _ in range(2):
        tables.insert_new(rows.unionByName(rows), path)
    return tables.read_table(spark, path, TRANSACTION_TABLE)


@register
def insert_or_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = _stored_purchases(spark, sf_dir)
    for _ in range(2):
        tables.insert_or_update(rows, path)
    return tables.read_table(spark, path, TRANSACTION_TABLE)


@register
def ingest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "transactions")
    for _ in range(2):
        ingest.ingest_messages(fixtures.messages(spark, sf_dir), path)
    return tables.read_table(spark, path, TRANSACTION_TABLE)


@register
def ingest_troubled_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two targets; later copies are broken, and an earlier one comes in a later load. All loads read one topic."""
    topic, first, second = (scratch_path(spark, n) for n in ("topic", "transactions", "transactions"))
    options = {"path": topic, "maxRecordsPerFile": "100000"}  # copies of a kind lie together: many files deal them out
    topics.produce_messages(fixtures.troubled_messages(spark, sf_dir), options, format="parquet")
    troubled = read_batch(spark, {"path": topic}, format="parquet")
    for _ in range(2):
        ingest.ingest_messages(troubled, first, second)
    early = F.col("value").cast("string").contains('\\"status\\":\\"queued\\"')
    ingest.ingest_messages(troubled.where(early), first)
    ingest.ingest_messages(troubled.where(early), second)
    stored = [tables.read_table(spark, p, TRANSACTION_TABLE) for p in (first, second)]
    return stored[0].unionByName(stored[1])


@register
def ingest_troubled_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rejects there are; each message is loaded or rejected."""
    loaded, rejects = scratch_path(spark, "transactions"), scratch_path(spark, "rejects")
    ingest.ingest_messages(fixtures.troubled_messages(spark, sf_dir), loaded, rejects_path=rejects)
    return spark.read.schema("reject_reason STRING, raw STRING").parquet(rejects).groupBy("reject_reason").count()


@register
def compact_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small loads, then few files a day; the rows are the same."""
    path, rows = scratch_path(spark, "transactions"), _conformed(spark, sf_dir)
    number = F.substring("operation_id", 5, 20).cast("bigint")
    for part in range(6):
        tables.append_transactions(rows.where(number % 6 == part), path)
    compaction.compact(spark, path, TRANSACTION_TABLE, TXN_DAY, tables.TXN_SORT, options=key_index.BLOOM)
    return tables.read_table(spark, path, TRANSACTION_TABLE)


@register
def replace_days_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``replace_days``, with one switch for all days of a replacement."""
    path, whole = scratch_path(spark, "metrics"), _mart(spark, sf_dir)
    days = tables.days_between("2024-01-01", "2024-01-31")
    switched.replace_days(whole, path, days)
    fewer = whole.where(f"status = 'done' AND date_update <= '{REPLACED_WITH_ROWS}'")
    for _ in range(2):
        switched.replace_days(fewer, path, tables.days_between(REPLACED_FIRST, REPLACED_LAST))
    return switched.read_table(spark, path)


@register
def bucketed_account_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-account totals of a catalogue table that is placed by sender."""
    database, location = f"paymart_{uuid.uuid4().hex}", scratch_path(spark, "database")
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{location}'")
    table = f"`{database}`.transactions"
    bucketed.save_bucketed(_conformed(spark, sf_dir), table, buckets=8)
    return totals.account_day_totals(spark.table(table))


@register
def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded, rejects = scratch_path(spark, "transactions"), scratch_path(spark, "rejects")
    ingest.ingest_messages(fixtures.messages(spark, sf_dir, damaged=True), loaded, rejects_path=rejects)
    return spark.read.schema("reject_reason STRING, raw STRING").parquet(rejects)


@register
def create_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = f"paymart_{uuid.uuid4().hex}"
    tables.create_tables(
        spark,
        database,
        scratch_path(spark, "database"),
        {"transactions": (TRANSACTION_TABLE, TXN_DAY), "global_metrics": (METRICS, METRICS_DAY)},
    )
    rows = mart.global_metrics(fixtures.event_transactions(spark, sf_dir), fixtures.currencies(spark, sf_dir))
    spark.sql(f"INSERT INTO `{database}`.global_metrics BY NAME SELECT * FROM {{rows}}", rows=rows)
    return spark.table(f"`{database}`.global_metrics")


@register
def sync_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue table whose days are written by path."""
    database, location = f"paymart_{uuid.uuid4().hex}", scratch_path(spark, "database")
    tables.create_tables(spark, database, location, {"global_metrics": (METRICS_BY_STATUS, METRICS_DAY)})
    tables.append_metrics(_mart(spark, sf_dir), f"{location}/global_metrics")
    tables.sync_catalogue(spark, f"`{database}`.global_metrics")
    return spark.table(f"`{database}`.global_metrics")
