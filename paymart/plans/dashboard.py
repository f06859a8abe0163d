"""The queries behind the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.operators.rates import join_currency_names
from paymart.operators.totals import account_day_totals


def dashboard_source(metrics: DataFrame, names: DataFrame) -> DataFrame:
    """The mart with currency labels."""
    return join_currency_names(metrics, names).select(
        "date_update",
        "currency_from",
        "currency_name",
        "amount_total",
        "cnt_transactions",
        "avg_transactions_per_account",
        "cnt_accounts_make_transactions",
    )


def turnover_by_currency(metrics: DataFrame) -> DataFrame:
    """Converted transfers per day and currency."""
    return metrics.groupBy("date_update", "currency_from").agg(F.sum("amount_total").alias("turnover"))


def company_turnover(metrics: DataFrame) -> DataFrame:
    """Converted transfers per day, all currencies together."""
    return metrics.groupBy("date_update").agg(F.sum("amount_total").alias("turnover"))


def active_accounts_by_currency(transactions: DataFrame) -> DataFrame:
    """Distinct senders per day and currency.

    Taken from the transactions: the mart's counts per status do not add up.
    """
    per_account = account_day_totals(transactions)
    return per_account.groupBy("date_update", F.col("currency_code").alias("currency_from")).agg(
        F.count(F.lit(1)).alias("active_accounts")
    )


def avg_transactions_per_account(transactions: DataFrame) -> DataFrame:
    """Transactions per distinct sender, per day and currency, not rounded."""
    per_account = account_day_totals(transactions)
    return per_account.groupBy("date_update", F.col("currency_code").alias("currency_from")).agg(
        (F.sum("cnt_usr_transactions") / F.count(F.lit(1))).alias("avg_transactions")
    )
