"""Row filters. Each is a plain predicate that Catalyst pushes to the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.functions.calendar import business_day
from paymart.schemas import MESSAGE_TYPE, QUOTE_CURRENCY, TXN_DAY

Day = dt.date | str


def day_literal(day: Day) -> Column:
    return F.lit(day).cast("date")


def read_where(df: DataFrame, predicate: str | None = None) -> DataFrame:
    """A table read with an optional predicate in SQL text."""
    return df if predicate is None else df.where(predicate)


def filter_message_type(df: DataFrame, message_type: str = MESSAGE_TYPE) -> DataFrame:
    return df.where(F.col("object_type") == F.lit(message_type))


def filter_real_accounts(df: DataFrame) -> DataFrame:
    """Leave out transactions from or to a test account."""
    return df.where((F.col("account_number_from") > 0) & (F.col("account_number_to") > 0))


def filter_days(df: DataFrame, first: Day, last: Day) -> DataFrame:
    """Transactions of the days ``first`` to ``last``, both included.

    A stored table is cut by its partition column, so no other day is listed
    or read; otherwise the bound goes to the raw time as a range.
    """
    first_day, last_day = day_literal(first), day_literal(last)
    if TXN_DAY in df.columns:
        return df.where(F.col(TXN_DAY).between(first_day, last_day))
    kind = df.schema["transaction_dt"].dataType
    start = first_day.cast(kind)
    end = F.date_add(last_day, 1).cast(kind)
    return df.where((F.col("transaction_dt") >= start) & (F.col("transaction_dt") < end))


def filter_business_day(df: DataFrame, day: Day) -> DataFrame:
    if TXN_DAY in df.columns:
        return df.where(F.col(TXN_DAY) == day_literal(day))
    return df.where(business_day("transaction_dt") == day_literal(day))


def filter_rate_days(rates: DataFrame, first: Day, last: Day) -> DataFrame:
    """The same bound for the rates side of the join.

    Catalyst does not carry the transactions' day filter over to the rates, so
    it is stated here; as the day is a join key, no match is lost.
    """
    return rates.where(F.col("date_update").between(day_literal(first), day_literal(last)))


def filter_quote_currency(rates: DataFrame, quote: int = QUOTE_CURRENCY) -> DataFrame:
    return rates.where(F.col("currency_code_with") == quote).select(
        "currency_code", "date_update", "currency_with_div"
    )
