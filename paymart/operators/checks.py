"""Data checks. Each report is one aggregate or anti join and returns a frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paymart.functions.calendar import business_day
from paymart.functions.messages import parse_messages
from paymart.operators.filters import filter_quote_currency, filter_real_accounts
from paymart.schemas import INT32_MAX, INT32_MIN, QUOTE_CURRENCY


class EmptyLoadError(ValueError):
    """A load that has to bring rows brought none."""


def require_rows(df: DataFrame, what: str = "the load") -> DataFrame:
    """Pass the frame on, or fail if it is empty.

    Call it before a shuffle: then the test stops at the first row found.
    """
    if not df.take(1):
        raise EmptyLoadError(f"{what} has no rows")
    return df


def any_null(columns: Sequence[str]) -> Column:
    """True for a row that lacks one of the required values."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def not_null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with NULL, per required column; one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def unique_key_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def domain_report(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside the documented ones, with their number of rows.

    The frame is read once for all columns, and only the bad values are
    shuffled, already counted per task.
    """
    checks = [
        F.when(
            ~F.coalesce(F.col(c).isin(list(allowed)), F.lit(False)),
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("bad_value")),
        )
        for c, allowed in domains.items()
    ]
    found = df.select(F.inline(F.array_compact(F.array(*checks))))
    return found.groupBy("column_name", "bad_value").agg(F.count(F.lit(1)).alias("row_count"))


def int_range_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: number of values that a 32-bit integer cannot hold, and their bounds."""
    outside = {c: F.when(~F.col(c).between(INT32_MIN, INT32_MAX), F.col(c).cast("bigint")) for c in columns}
    counted = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.count(v).alias("out_of_range"),
                    F.min(v).alias("lowest"),
                    F.max(v).alias("highest"),
                )
                for c, v in outside.items()
            ]
        ).alias("columns")
    )
    return counted.select(F.inline("columns"))


def quarantine(messages: DataFrame, field: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split messages into parsed ones and ones that did not parse.

    Parsed: raw text, envelope ``e`` and transaction ``t``. Not parsed: the
    raw text and which of the two parts failed.
    """
    parsed = parse_messages(messages, field)
    good = parsed.where(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = parsed.where(F.col("reject_reason").isNotNull()).select("reject_reason", "raw")
    return good, bad


def missing_rate_report(
    transactions: DataFrame, rates: DataFrame, quote: int = QUOTE_CURRENCY
) -> DataFrame:
    """Day and currency pairs that the mart converts with the fallback rate 1."""
    real = filter_real_accounts(transactions).where(F.col("currency_code") != quote)
    used = real.groupBy(business_day("transaction_dt").alias("date_update"), "currency_code").agg(
        F.count(F.lit(1)).alias("cnt_transactions")
    )
    usable = filter_quote_currency(rates, quote).where("currency_with_div > 0")
    return used.join(usable, ["date_update", "currency_code"], "left_anti")


# --- All reports from one pass ------------------------------------------------

FACTS = "kind STRING, name STRING, value STRING, row_count BIGINT, lowest BIGINT, highest BIGINT"


def load_facts(
    transactions: DataFrame,
    required: Sequence[str],
    domains: Mapping[str, Sequence[str]],
    whole_numbers: Sequence[str],
    key: Sequence[str],
    quote: int = QUOTE_CURRENCY,
) -> DataFrame:
    """What all reports need to know about a load, from one read of it.

    Each row states its facts: a required value that is missing, a value outside
    its domain or outside 32 bits, its key, the day and currency it is converted
    with. They are counted per task before they are exchanged; only keys do not
    become fewer by that. Of the keys, those that occur once are left out. The
    result is small, so store it beside the load and ask it as often as needed.
    """
    none = F.lit(None).cast("string")

    def fact(kind: str, name: str, value: Column = none, number: Column | None = None) -> Column:
        number = F.lit(None).cast("bigint") if number is None else number.cast("bigint")
        return F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), value.alias("value"), number.alias("number"))

    real = F.coalesce((F.col("account_number_from") > 0) & (F.col("account_number_to") > 0), F.lit(False))
    cell = F.to_json(F.struct(business_day("transaction_dt").alias("date_update"), "currency_code"))
    facts = [F.when(F.col(c).isNull(), fact("null", c)) for c in required]
    facts += [
        F.when(~F.coalesce(F.col(c).isin(list(allowed)), F.lit(False)), fact("domain", c, F.col(c).cast("string")))
        for c, allowed in domains.items()
    ]
    facts += [F.when(~F.col(c).between(INT32_MIN, INT32_MAX), fact("range", c, none, F.col(c))) for c in whole_numbers]
    facts.append(fact("key", ",".join(key), F.to_json(F.struct(*key))))
    facts.append(F.when(real & (F.col("currency_code") != quote), fact("rate", "cell", cell)))
    stated = transactions.select(F.inline(F.array_compact(F.array(*facts))))
    counted = stated.groupBy("kind", "name", "value").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("number").alias("lowest"), F.max("number").alias("highest")
    )
    return counted.where("kind <> 'key' OR row_count > 1")


def _of_kind(facts: DataFrame, kind: str) -> DataFrame:
    return facts.where(F.col("kind") == kind)


def _per_column(facts: DataFrame, kind: str, columns: Sequence[str]) -> DataFrame:
    """One row per column, also where nothing was found."""
    names = facts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name"))
    found = _of_kind(facts, kind).withColumnRenamed("name", "column_name")
    return names.join(found, "column_name", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))


def null_report_of(facts: DataFrame, required: Sequence[str]) -> DataFrame:
    """``not_null_report`` from the facts of a load."""
    return _per_column(facts, "null", required).select("column_name", F.col("row_count").alias("null_count"))


def domain_report_of(facts: DataFrame) -> DataFrame:
    """``domain_report`` from the facts of a load."""
    return _of_kind(facts, "domain").select(F.col("name").alias("column_name"), F.col("value").alias("bad_value"), "row_count")


def int_range_report_of(facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``int_range_report`` from the facts of a load."""
    found = _per_column(facts, "range", columns)
    return found.select("column_name", F.col("row_count").alias("out_of_range"), "lowest", "highest")


def unique_key_report_of(facts: DataFrame, key: StructType) -> DataFrame:
    """``unique_key_report`` from the facts of a load; ``key`` is the layout of the key columns."""
    found = _of_kind(facts, "key").select(F.from_json("value", key).alias("k"), "row_count")
    return found.select("k.*", "row_count")


def missing_rate_report_of(facts: DataFrame, rates: DataFrame, quote: int = QUOTE_CURRENCY) -> DataFrame:
    """``missing_rate_report`` from the facts of a load and the rates; a row per day and currency meets them."""
    layout = "date_update DATE, currency_code INT"
    cells = _of_kind(facts, "rate").select(F.from_json("value", layout).alias("c"), F.col("row_count").alias("cnt_transactions"))
    used = cells.select("c.*", "cnt_transactions")
    usable = filter_quote_currency(rates, quote).where("currency_with_div > 0")
    return used.join(usable, ["date_update", "currency_code"], "left_anti")
