"""Batch queries: reads, projections, joins, aggregates, dashboard and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paymart import fixtures, functions
from paymart.functions import messages as msg
from paymart.operators import checks, dedup, filters, rates, totals, upsert
from paymart.plans import dashboard, ingest, mart
from paymart.queries.shaping import as_text, plain_times, registry
from paymart.schemas import (
    RATE_KEY,
    RATES,
    STATUSES,
    TRANSACTION_TYPES,
    TXN_COLUMNS,
    TXN_DAY,
)
from paymart.session import scratch_path
from paymart.sources import objects, sqlfile

QUERIES, register = registry()

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Days that the parameterised queries ask for.
ONE_DAY = "1996-03-15"
FIRST_DAY = "1996-10-02"
LAST_DAY = "1996-11-01"

LARGE_AMOUNT = 1_200_000_000_000_000_000


# --- Sources ----------------------------------------------------------------


@register
def profile_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = [
        objects.profile_source(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        .groupBy(F.lit(name).alias("source"))
        .agg(F.sum("n_rows").alias("n_rows"), F.max("n_columns").alias("n_columns"))
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, profiles)


@register
def read_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixtures.table(spark, sf_dir, "orders")
    return filters.read_where(orders, "o_totalprice > 250000 AND o_orderstatus = 'F'")


@register
def select_transaction_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.from_events(fixtures.table(spark, sf_dir, "events"))
    return functions.select_transaction_columns(events)


@register
def run_sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sqlfile.run_sql_file(
        spark,
        sqlfile.METRICS_FOR_DAY,
        {"business_dt": ONE_DAY, "quote": 420},
        transactions=fixtures.transactions(spark, sf_dir),
        rates=fixtures.currencies(spark, sf_dir),
    )


@register
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects.preview(fixtures.currencies(spark, sf_dir), ["date_update", "currency_code", "currency_code_with"])


# --- Projections, filters, scalar functions ---------------------------------


@register
def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return functions.decode_json(fixtures.table(spark, sf_dir, "events"), "props", "k INT")


@register
def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(functions.decode_envelope(fixtures.messages(spark, sf_dir)))


@register
def decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(functions.decode_payload(functions.decode_envelope(fixtures.messages(spark, sf_dir))))


@register
def filter_message_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = functions.decode_envelope(fixtures.messages(spark, sf_dir))
    return plain_times(filters.filter_message_type(envelopes))


@register
def transactions_from_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.transactions_from_messages(fixtures.messages(spark, sf_dir))


@register
def filter_real_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_real_accounts(fixtures.transactions(spark, sf_dir))


@register
def filter_business_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_business_day(fixtures.transactions(spark, sf_dir), ONE_DAY)


@register
def filter_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_days(fixtures.transactions(spark, sf_dir), FIRST_DAY, LAST_DAY)


@register
def filter_quote_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_quote_currency(fixtures.currencies(spark, sf_dir))


@register
def rate_positive_else_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rated(spark, sf_dir).withColumn("rate", functions.rate_positive_else_one("currency_with_div"))


@register
def rate_coalesce_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rated(spark, sf_dir).withColumn("rate", functions.rate_coalesce_one("currency_with_div"))


@register
def convert_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = rate_positive_else_one(spark, sf_dir)
    return rated.select("operation_id", functions.convert_amount("amount", "rate").alias("converted"))


@register
def round_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = rate_positive_else_one(spark, sf_dir)
    converted = functions.convert_amount("amount", "rate") / 8
    return rated.select(
        "operation_id",
        functions.round_total(converted).alias("half_even"),
        functions.round_total(converted, "half_up").alias("half_up"),
    )


@register
def round_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    eighths = F.col("amount") / 8
    return fixtures.event_transactions(spark, sf_dir).select(
        "operation_id",
        functions.round_average(eighths).alias("half_even"),
        functions.round_average(eighths, "half_up").alias("half_up"),
    )


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.event_transactions(spark, sf_dir)
    quoted = filters.filter_quote_currency(fixtures.currencies(spark, sf_dir))
    dated = events.select(
        "operation_id", "currency_code", "amount", functions.business_day("transaction_dt").alias("date_update")
    )
    return dated.join(quoted, ["date_update", "currency_code"], "left")


@register
def business_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.event_transactions(spark, sf_dir).select(
        "operation_id",
        functions.business_day("transaction_dt").alias("day"),
        functions.business_day_trunc("transaction_dt").alias("midnight"),
    )


@register
def currency_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = fixtures.transactions(spark, sf_dir)
    return labelled.select("operation_id", functions.currency_label("country").alias("currency_name"))


@register
def encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.event_transactions(spark, sf_dir)
    return functions.encode_json(events, TXN_COLUMNS).select("operation_id", "payload")


@register
def to_target_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = "currency_code,currency_code_with,date_update,currency_with_div"
    shuffled = fixtures.currencies(spark, sf_dir).select(*sorted(RATES.fieldNames()), F.lit("x").alias("not_loaded"))
    return functions.to_target_columns(shuffled, header.split(","))


@register
def conform_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.event_transactions(spark, sf_dir)
    as_read = texts.select(
        *[F.col(c) if c == "transaction_dt" else F.col(c).cast("string").alias(c) for c in texts.columns]
    )
    return functions.conform_transaction(as_read)


@register
def conform_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.currencies(spark, sf_dir)
    return functions.conform_rate(texts.select(*[F.col(c).cast("string").alias(c) for c in texts.columns]))


# --- Joins ------------------------------------------------------------------


@register
def join_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_account = totals.account_day_status_totals(fixtures.transactions(spark, sf_dir))
    return rates.join_rates(per_account, fixtures.currencies(spark, sf_dir))


@register
def join_currency_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.join_currency_names(global_metrics(spark, sf_dir), currency_names(spark, sf_dir))


@register
def new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.event_transactions(spark, sf_dir)
    return upsert.new_rows(events.where("status = 'done'"), events, ["operation_id"])


# --- Aggregates -------------------------------------------------------------


@register
def account_day_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.account_day_totals(fixtures.event_transactions(spark, sf_dir))


@register
def account_day_status_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.account_day_status_totals(fixtures.event_transactions(spark, sf_dir))


@register
def global_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.global_metrics(fixtures.transactions(spark, sf_dir), fixtures.currencies(spark, sf_dir))


@register
def global_metrics_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.global_metrics_by_status(fixtures.transactions(spark, sf_dir), fixtures.currencies(spark, sf_dir))


@register
def global_metrics_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.global_metrics(fixtures.event_transactions(spark, sf_dir), fixtures.currencies(spark, sf_dir))


@register
def global_metrics_by_status_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.event_transactions(spark, sf_dir)
    return mart.global_metrics_by_status(events, fixtures.currencies(spark, sf_dir), rounding="half_up")


@register
def global_metrics_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rate loaded twice and a conflicting one next to it, nothing deduped."""
    events = fixtures.event_transactions(spark, sf_dir)
    single = fixtures.currencies(spark, sf_dir)
    conflicting = single.withColumn("currency_with_div", F.col("currency_with_div") + F.col("currency_with_div"))
    loaded = single.unionByName(single).unionByName(conflicting)
    return mart.global_metrics_by_status(events, loaded, dedupe=False)


@register
def currency_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.currency_names(fixtures.transactions(spark, sf_dir))


@register
def dedupe_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    single = fixtures.currencies(spark, sf_dir)
    return rates.dedupe_rates(single.unionByName(single))


@register
def metrics_for_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.metrics_for_day(
        fixtures.transactions(spark, sf_dir), fixtures.currencies(spark, sf_dir), ONE_DAY
    )


@register
def metrics_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.metrics_backfill(
        fixtures.transactions(spark, sf_dir), fixtures.currencies(spark, sf_dir), FIRST_DAY, LAST_DAY
    )


@register
def metrics_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.metrics_ordered(global_metrics_of_events(spark, sf_dir))


# --- Dashboard --------------------------------------------------------------


@register
def dashboard_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dashboard_source(global_metrics(spark, sf_dir), currency_names(spark, sf_dir))


@register
def turnover_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.turnover_by_currency(global_metrics_by_status(spark, sf_dir))


@register
def active_accounts_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.active_accounts_by_currency(fixtures.event_transactions(spark, sf_dir))


@register
def avg_transactions_per_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.avg_transactions_per_account(fixtures.event_transactions(spark, sf_dir))


@register
def company_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.company_turnover(global_metrics_by_status(spark, sf_dir))


@register
def global_metrics_large_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction of each cell of the mart is above 10^18."""
    transactions = fixtures.event_transactions(spark, sf_dir)
    cell = [functions.business_day("transaction_dt"), "currency_code", "status"]
    first = transactions.where("account_number_from > 0 AND account_number_to > 0").groupBy(*cell).agg(
        F.min("operation_id").alias("large_id")
    )
    large = first.select(F.col("large_id").alias("operation_id"), F.lit(True).alias("is_large"))
    marked = transactions.join(large, "operation_id", "left")
    amount = F.when(F.col("is_large"), F.lit(LARGE_AMOUNT) + F.col("amount")).otherwise(F.col("amount"))
    return mart.global_metrics_by_status(
        marked.withColumn("amount", amount).select(*TXN_COLUMNS), fixtures.currencies(spark, sf_dir)
    )


HUGE_AMOUNT = 5 * 10**18  # two of them are beyond BIGINT


def huge_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with amounts of which two exceed BIGINT."""
    events = fixtures.event_transactions(spark, sf_dir)
    return events.withColumn("amount", F.lit(HUGE_AMOUNT) + F.col("amount"))


@register
def account_day_totals_any_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.account_day_totals(huge_transactions(spark, sf_dir), wide=True)


@register
def global_metrics_any_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = fixtures.currencies(spark, sf_dir)
    return mart.global_metrics(huge_transactions(spark, sf_dir), rated, wide=True)


@register
def global_metrics_by_status_any_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = fixtures.currencies(spark, sf_dir)
    return mart.global_metrics_by_status(huge_transactions(spark, sf_dir), rated, wide=True)


# --- Dedup and upserts ------------------------------------------------------


@register
def dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = functions.decode_envelope(fixtures.messages(spark, sf_dir))
    return plain_times(dedup.dedup_by_id(envelopes))


def _upsert_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target: purchases with other values. Rows: all events, each one twice."""
    events = fixtures.event_transactions(spark, sf_dir)
    target = events.where("status = 'done'").select(
        *[F.lit("stored").alias(c) if c in ("country", "transaction_type") else c for c in TXN_COLUMNS]
    )
    return target, events.unionByName(events)


@register
def upsert_do_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, rows = _upsert_sides(spark, sf_dir)
    return upsert.upsert_do_nothing(target, rows, ["operation_id"])


@register
def upsert_do_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, rows = _upsert_sides(spark, sf_dir)
    return upsert.upsert_do_update(target, rows, ["operation_id"])


@register
def upsert_do_update_some_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows lack one column, and bring NULL in another for half the keys."""
    target, rows = _upsert_sides(spark, sf_dir)
    kind = F.when(F.col("transaction_type") == "sbp_incoming", F.col("transaction_type"))
    return upsert.upsert_do_update(
        target, rows.drop("country").withColumn("transaction_type", kind), ["operation_id"]
    )


# --- Checks -----------------------------------------------------------------


@register
def require_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.require_rows(fixtures.event_transactions(spark, sf_dir), "events")


@register
def not_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = functions.decode_envelope(fixtures.messages(spark, sf_dir, damaged=True))
    return checks.not_null_report(functions.decode_payload(damaged), TXN_COLUMNS)


@register
def unique_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = functions.decode_envelope(fixtures.messages(spark, sf_dir))
    return checks.unique_key_report(envelopes, ["object_type", "object_id"])


@register
def unique_rate_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    single = fixtures.currencies(spark, sf_dir)
    doubled = single.withColumn("currency_with_div", F.col("currency_with_div") + F.col("currency_with_div"))
    return checks.unique_key_report(rates.dedupe_rates(single.unionByName(doubled)), RATE_KEY)


@register
def moved_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh operation came again a day later."""
    rows = functions.conform_transaction(fixtures.event_transactions(spark, sf_dir))
    again = rows.where("CAST(substring(operation_id, 5) AS BIGINT) % 7 = 0").withColumn(TXN_DAY, F.date_add(TXN_DAY, 1))
    return ingest.moved_operations(rows.unionByName(again))


@register
def domain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("status"), F.concat(F.lit("sbp_"), F.col("event_type")).alias("transaction_type")
    )
    known = fixtures.event_transactions(spark, sf_dir).select("status", "transaction_type")
    domains = {"status": STATUSES, "transaction_type": TRANSACTION_TYPES}
    return checks.domain_report(raw.unionByName(known), domains)


@register
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = checks.quarantine(fixtures.messages(spark, sf_dir, damaged=True))
    return bad


@register
def quarantine_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = checks.quarantine(fixtures.messages(spark, sf_dir, damaged=True))
    return plain_times(good.select("t.*"))


@register
def quarantine_troubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = checks.quarantine(fixtures.troubled_messages(spark, sf_dir))
    return bad.groupBy("reject_reason").count()


@register
def int_range_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = fixtures.transactions(spark, sf_dir).withColumn("amount", F.col("amount") * 100)
    return checks.int_range_report(scaled, ["amount", "account_number_from", "currency_code"])


@register
def missing_rate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.missing_rate_report(fixtures.transactions(spark, sf_dir), fixtures.currencies(spark, sf_dir))


@register
def load_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with values that each report finds; all reports in one frame."""
    rows = fixtures.transactions(spark, sf_dir)
    number = F.col("operation_id").cast("bigint")
    rows = rows.select(
        *[
            {
                "operation_id": F.when(number % 9 == 0, "none").otherwise(F.col("operation_id")).alias("operation_id"),
                "country": F.when(number % 5 != 0, F.col("country")).alias("country"),
                "status": F.when(number % 4 == 0, F.concat(F.lit("x"), "status")).otherwise(F.col("status")).alias("status"),
                "amount": (F.col("amount") * 100).alias("amount"),
            }.get(c, F.col(c))
            for c in TXN_COLUMNS
        ]
    )
    facts = ingest.transaction_facts(rows)
    spread = scratch_path(spark, "facts")
    facts.write.parquet(spread)
    facts = spark.read.schema(checks.FACTS).parquet(spread)
    null, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def told(report: str, df: DataFrame, name, value, n, low=number, high=number) -> DataFrame:
        columns = {"name": name, "value": value, "row_count": n, "lowest": low, "highest": high}
        return df.select(F.lit(report).alias("report"), *[F.col(c).alias(a) if isinstance(c, str) else c.alias(a) for a, c in columns.items()])

    cells = checks.missing_rate_report_of(facts, fixtures.currencies(spark, sf_dir))
    cell = F.concat_ws(" ", F.col("date_update").cast("string"), F.col("currency_code").cast("string"))
    key = StructType([StructField("operation_id", StringType())])
    reports = [
        told("null", checks.null_report_of(facts, TXN_COLUMNS), "column_name", null, "null_count"),
        told("domain", checks.domain_report_of(facts), "column_name", "bad_value", "row_count"),
        told("range", checks.int_range_report_of(facts, ["amount"]), "column_name", null, "out_of_range", "lowest", "highest"),
        told("key", checks.unique_key_report_of(facts, key), F.lit("operation_id"), "operation_id", "row_count"),
        told("rate", cells, F.lit("cell"), cell, "cnt_transactions"),
    ]
    return reduce(DataFrame.unionByName, reports)


# --- Messages ---------------------------------------------------------------


@register
def encode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(msg.encode_messages(fixtures.event_transactions(spark, sf_dir)))
