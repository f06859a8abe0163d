"""Per-account totals: the first of the two grains of the mart.

Both aggregates combine on the map side, so however many rows one account or
one day holds, a task sends at most one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.functions.calendar import business_day
from paymart.operators.filters import filter_real_accounts
from paymart.schemas import TXN_DAY


def _account_totals(transactions: DataFrame, extra: Sequence[str], wide: bool) -> DataFrame:
    real = filter_real_accounts(transactions)
    day = F.col(TXN_DAY) if TXN_DAY in transactions.columns else business_day("transaction_dt")
    amount = F.sum(F.col("amount").cast("decimal(20,0)")) if wide else F.sum("amount")
    return real.groupBy(
        day.alias("date_update"), "currency_code", *extra, "account_number_from"
    ).agg(
        amount.alias("amount_total"),
        F.count(F.lit(1)).alias("cnt_usr_transactions"),
    )


def account_day_totals(transactions: DataFrame, wide: bool = False) -> DataFrame:
    """By day, currency and sender: amount and number of transactions.

    The amount is BIGINT, and a sum beyond it an error; with ``wide`` it is
    DECIMAL(30,0), which holds the sum of any BIGINT amounts.
    """
    return _account_totals(transactions, [], wide)


def account_day_status_totals(transactions: DataFrame, wide: bool = False) -> DataFrame:
    """The same with the status in the key."""
    return _account_totals(transactions, ["status"], wide)


def currency_names(transactions: DataFrame) -> DataFrame:
    """The distinct pairs of country and currency; one row per country at most few."""
    return transactions.select("country", "currency_code").distinct()
