"""The three jobs: messages to table, rates to table, a range of days to the mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.functions.columns import conform_rate, conform_transaction
from paymart.functions.messages import parse_messages
from paymart.operators.checks import EmptyLoadError, any_null, load_facts, require_rows, unique_key_report
from paymart.operators.dedup import one_per_key
from paymart.operators.filters import Day
from paymart.plans.mart import global_metrics_by_status
from paymart.schemas import (
    MESSAGE_TYPE,
    METRICS_BY_STATUS,
    METRICS_BY_STATUS_WIDE,
    RATE_KEY,
    STATUSES,
    TRANSACTION_TABLE,
    TRANSACTION_TYPES,
    TXN_COLUMNS,
    TXN_DAY,
)
from paymart.session import scratch_path
from paymart.sinks import feed, files
from paymart.sinks.operations import store_operations
from paymart.sinks.tables import (
    days_between,
    in_days,
    load_rates,
    read_days,
    read_rates,
    replace_listed_days,
)
from paymart.sources.rates import bad_rates, good_rates, read_rates_csv

# Stored with a loaded transaction: of several copies the one sent last stays.
SENT = [T.StructField("sent_dttm", T.TimestampNTZType())]

# Days that a transaction can have. Others come from broken clocks; each would
# be a directory of its own.
PLAUSIBLE_DAYS = ("1990-01-01", "2100-01-01")


class ConflictingRatesError(ValueError):
    """A rate file with different rates for one day and pair of currencies."""


class BadRatesError(ValueError):
    """A rate file with too many lines that are no rates."""


def _plausible(time: Column | str) -> Column:
    day = F.to_date(time)
    return (day >= F.lit(PLAUSIBLE_DAYS[0]).cast("date")) & (day < F.lit(PLAUSIBLE_DAYS[1]).cast("date"))


def judged_messages(messages: DataFrame) -> DataFrame:
    """Every message once: its text and why it is rejected, or its transaction.

    Columns raw, reject_reason, is_ours (of the type loaded), is_transaction (and
    complete), id, sent_dttm and those of a transaction. Reasons: ``envelope`` or ``payload`` (that part is not JSON),
    ``type`` (the envelope does not say what it holds), ``null`` (a required
    value is missing or not of its type), ``day`` (not a plausible one).
    """
    parsed = parse_messages(messages).select("raw", "e.object_id", "e.object_type", "e.sent_dttm", "t.*", "reject_reason")
    ours = F.coalesce(F.col("object_type") == MESSAGE_TYPE, F.lit(False))
    reason = F.coalesce(
        "reject_reason",
        F.when(ours & any_null(TXN_COLUMNS), F.lit("null")),
        F.when(ours & ~_plausible("transaction_dt"), F.lit("day")),
    )
    reasoned = parsed.withColumn("reject_reason", reason)
    return reasoned.select(
        F.when(F.col("reject_reason").isNotNull(), F.col("raw")).alias("raw"),
        "reject_reason",
        ours.alias("is_ours"),
        (ours & F.col("reject_reason").isNull()).alias("is_transaction"),
        F.coalesce("object_id", "operation_id").alias("id"),
        F.col("sent_dttm").cast("timestamp_ntz").alias("sent_dttm"),
        *TXN_COLUMNS,
    )


def transactions_from_messages(messages: DataFrame) -> DataFrame:
    """Topic messages to rows of the transactions table, one per id: the last sent that is complete."""
    return _stored_rows(judged_messages(messages)).select(*TRANSACTION_TABLE.fieldNames())


def _stored_rows(judged: DataFrame, *extra: str) -> DataFrame:
    """One row per id, the last sent one, in the columns of the table and with its time of sending.

    Rejected rows are gone by then, so a broken copy that was sent last does
    not hide a good one. A message without an id goes by the operation in its
    payload, so that different ones do not fall together.
    """
    rows = judged.where("is_transaction").select("id", "sent_dttm", *TXN_COLUMNS)
    latest = one_per_key(rows, ["id"], ["sent_dttm"])
    conformed = conform_transaction(latest.withColumnRenamed("sent_dttm", "sent"), "sent", *extra)
    return conformed.withColumnRenamed("sent", "sent_dttm")


def rejected_messages(messages: DataFrame) -> DataFrame:
    """Texts that do not become a row of the table, and why."""
    return judged_messages(messages).select("reject_reason", "raw").where("reject_reason IS NOT NULL")


def transaction_facts(rows: DataFrame) -> DataFrame:
    """The facts that all reports on a load of transactions come from."""
    domains = {"status": STATUSES, "transaction_type": TRANSACTION_TYPES}
    return load_facts(rows, TXN_COLUMNS, domains, ["amount"], ["operation_id"])


def load_messages(
    messages: DataFrame,
    *paths: str,
    rejects_path: str | None = None,
    required: bool = False,
    facts_path: str | None = None,
) -> list[int]:
    """Read and parse messages once, and give them to one or more tables.

    An operation is stored once over all days; one that comes again with
    another day moves there. The rows to load are staged in the shared folder,
    and where rejects are kept the parsed messages as well: rejects and all
    targets come from the same read, whatever arrives meanwhile and whichever
    executor is lost. Returns the rows inserted or replaced by newer ones, per
    table; the days that each table's load touched are in its feed. With
    ``facts_path`` the facts of the load are stored there, for the reports of
    ``operators.checks``.
    """
    spark = messages.sparkSession
    judged, ours = judged_messages(messages), Observation()
    judged = judged.observe(ours, F.count_if("is_ours").alias("n"))
    if rejects_path:
        staged = scratch_path(spark, "messages")
        judged.write.parquet(staged)
        judged = spark.read.schema(judged.schema).parquet(staged)
        rejects = judged.where("reject_reason IS NOT NULL").select("reject_reason", "raw")
        rejects.write.mode("overwrite").parquet(rejects_path)
    newest, seen = scratch_path(spark, "newest"), Observation()
    other_id = F.col("id") != F.col("operation_id")
    rows = _stored_rows(judged, "id").observe(
        seen, F.count(F.lit(1)).alias("n"), F.count_if(other_id).alias("n_other"), F.collect_set(TXN_DAY).alias("days")
    )
    rows.drop("id").write.parquet(newest)
    if required and not ours.get.get("n"):
        raise EmptyLoadError("the topic has no rows of the type")
    n, n_other = (seen.get.get(c) or 0 for c in ("n", "n_other"))
    rows = spark.read.schema(T.StructType([*TRANSACTION_TABLE.fields, *SENT])).parquet(newest)
    if n_other:  # messages of several ids may hold one operation
        rows, counted = one_per_key(rows, ["operation_id"], ["sent_dttm"]), Observation()
        single = scratch_path(spark, "newest")
        rows.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(single)
        n, rows = counted.get.get("n"), spark.read.schema(rows.schema).parquet(single)
    if facts_path:
        transaction_facts(rows).write.mode("overwrite").parquet(facts_path)
    # Days of messages that another id's replaced may be among them: a day more costs nothing.
    return [store_operations(rows, path, SENT, n, days=seen.get.get("days")) for path in paths]


def ingest_messages(
    messages: DataFrame, *paths: str, rejects_path: str | None = None, facts_path: str | None = None
) -> list[int]:
    """The daily load of a topic into each of the tables; an empty topic is an error.

    Rejected texts go to ``rejects_path``, a folder of this load alone. A topic
    may be read from its start each day; to read only what is new, use
    ``stream_upsert`` once a day, which keeps the offsets it has read.
    """
    return load_messages(messages, *paths, rejects_path=rejects_path, required=True, facts_path=facts_path)


def moved_operations(transactions: DataFrame) -> DataFrame:
    """Operations that are stored under more than one day, with the number of rows.

    ``load_messages`` leaves none. Tables that were filled by ``append_transactions``
    or by day (``insert_new``) can have some.
    """
    return unique_key_report(transactions.select("operation_id", TXN_DAY).distinct(), ["operation_id"])


def ingest_rates(
    spark: SparkSession, csv_path: str, *paths: str, rejects_path: str | None = None, most_bad: float = 0.01
) -> list[int]:
    """Replace the stored rate history by the file's good lines.

    Bad lines go to ``rejects_path``. As the whole history is replaced, a bad
    line takes a stored rate away: more than the share ``most_bad`` of them
    fails the load, and so do different rates for one key. Nothing is replaced
    then.
    """
    lines = read_rates_csv(spark, csv_path)
    rates = conform_rate(good_rates(lines))
    bad = bad_rates(lines)
    if rejects_path:
        bad.select(F.col("_corrupt_record").alias("line")).write.mode("overwrite").parquet(rejects_path)
    require_rows(rates, csv_path)
    n_bad, n_good = bad.count(), rates.count()
    if n_bad > most_bad * (n_bad + n_good):
        raise BadRatesError(f"{csv_path}: {n_bad} of {n_bad + n_good} lines are no rates")
    conflict = unique_key_report(rates.distinct(), RATE_KEY).take(1)
    if conflict:
        raise ConflictingRatesError(f"{csv_path}: {conflict[0]}")
    changed = [_days_with_other_rates(rates, path) for path in paths]
    for path, days in zip(paths, changed):
        feed.record(spark, path, days)
    written = load_rates(rates, *paths)
    for path, days in zip(paths, changed):
        feed.record(spark, path, days)
    return written


def _days_with_other_rates(rates: DataFrame, path: str) -> list[dt.date]:
    """Days whose rates differ from the stored ones; all days where none are stored."""
    rates = rates.distinct()
    if files.current_version(rates.sparkSession, path) is not None:
        stored = read_rates(rates.sparkSession, path)
        rates = rates.exceptAll(stored).unionAll(stored.exceptAll(rates))
    return [r[0] for r in rates.select("date_update").distinct().collect() if r[0] is not None]


def update_mart(
    spark: SparkSession,
    transactions_path: str,
    rates_path: str,
    mart_path: str,
    first: Day | None = None,
    last: Day | None = None,
    replace: Callable[..., int] = replace_listed_days,
    wide: bool = False,
) -> int:
    """Recompute days from the stored tables and put them in place.

    With ``first`` and ``last`` these are a range; without, the days that loads of
    transactions or rates have touched since the last such update, and none if
    there are none. Late messages and corrected rates so reach the mart, and no
    other day is read. Days are marked as done only when they are in place, so
    an update that fails is done again by the next one.

    Both inputs have to be there, and rates have to have rows: otherwise all
    rates would be 1 or all days empty, and the mart is left as it is.
    ``replace`` puts the days in place: ``switched.replace_days`` shows them to readers
    at once. ``wide`` stores totals that no sum exceeds.
    """
    files.require_path(spark, transactions_path)
    rates = require_rows(read_rates(spark, rates_path), rates_path)
    names: list[str] = []
    if first is None and last is None:
        found = [feed.open_days(spark, path) for path in (transactions_path, rates_path)]
        names, days = [n for ns, _ in found for n in ns], sorted(set().union(*(ds for _, ds in found)))
    else:
        days = days_between(first, last)
    n = 0
    if days:
        transactions = read_days(spark, transactions_path, TRANSACTION_TABLE, TXN_DAY, days)
        rated = rates.where(in_days("date_update", days))
        metrics = global_metrics_by_status(transactions, rated, wide=wide)
        n = replace(metrics, mart_path, days, METRICS_BY_STATUS_WIDE if wide else METRICS_BY_STATUS)
    feed.mark_done(spark, names)
    return n
