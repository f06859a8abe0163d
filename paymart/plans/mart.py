"""The daily mart, with and without the status.

Shape of the plan, for any number of days at once:

1. scan with account filter and day range, four or five columns;
2. totals per day, currency, (status,) account: map-side combine, exchange;
3. cells per day, currency, (status): map-side combine, exchange of at most
   one row per cell and task;
4. the cells meet the rates, one row per day and currency.

The rate is the same for all accounts of a cell, so multiplying after step 3
gives the same exact decimals as multiplying each account's total, and the
join sees cells instead of accounts. As step 2 leaves one row per account, the
number of distinct senders is a plain count in step 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.functions.money import convert_amount, round_average, round_whole
from paymart.operators.filters import Day, day_literal, filter_business_day, filter_days, filter_rate_days
from paymart.operators.rates import rate_lookup
from paymart.operators.totals import account_day_status_totals, account_day_totals
from paymart.schemas import METRICS, METRICS_BY_STATUS, METRICS_WIDE, QUOTE_CURRENCY


def _mart(
    totals: DataFrame,
    rates: DataFrame,
    keys: list[str],
    columns: list[str],
    rate_rule: str,
    rounding: str,
    quote: int,
    dedupe: bool,
    wide: bool,
) -> DataFrame:
    cells = totals.groupBy(*keys).agg(
        F.sum("amount_total").alias("amount"),
        F.sum("cnt_usr_transactions").alias("cnt"),
        F.avg("cnt_usr_transactions").alias("avg_cnt"),
        F.count(F.lit(1)).alias("accounts"),
    )
    lookup = rate_lookup(rates, rate_rule, quote, dedupe)
    rated = cells.join(lookup, ["date_update", "currency_code"], "left")
    one = F.lit(1).cast("decimal(28,6)")
    total = round_whole(convert_amount("amount", F.coalesce("rate_sum", one)), rounding)
    return rated.select(
        "*",
        F.col("currency_code").alias("currency_from"),
        (total.cast(METRICS_WIDE["amount_total"].dataType) if wide else _as_bigint(total, keys)).alias("amount_total"),
        (F.col("cnt") * F.coalesce("n_rates", F.lit(1))).alias("cnt_transactions"),
        round_average("avg_cnt", rounding).alias("avg_transactions_per_account"),
        F.col("accounts").alias("cnt_accounts_make_transactions"),
    ).select(*columns)


def _as_bigint(total: Column, keys: list[str]) -> Column:
    """The total as BIGINT; one beyond it is an error that names its cell."""
    cell = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    error = F.raise_error(F.concat(F.lit("amount_total is beyond BIGINT, use wide=True: "), cell))
    fits = total.between(F.lit("-9223372036854775808").cast("decimal(20,0)"), F.lit("9223372036854775807").cast("decimal(20,0)"))
    return F.when(total.isNull() | fits, total.cast("bigint")).otherwise(error.cast("bigint"))


def global_metrics(
    transactions: DataFrame,
    rates: DataFrame,
    rate_rule: str = "coalesce_one",
    rounding: str = "half_even",
    quote: int = QUOTE_CURRENCY,
    dedupe: bool = True,
    wide: bool = False,
) -> DataFrame:
    """The mart by day and currency, all statuses together.

    Sums are exact whatever they reach. ``amount_total`` is BIGINT, and a cell
    beyond that an error which names it; with ``wide`` it is DECIMAL(38,0).
    """
    keys = ["date_update", "currency_code"]
    totals = account_day_totals(transactions, wide=True)
    return _mart(totals, rates, keys, METRICS.fieldNames(), rate_rule, rounding, quote, dedupe, wide)


def global_metrics_by_status(
    transactions: DataFrame,
    rates: DataFrame,
    rate_rule: str = "positive_else_one",
    rounding: str = "half_even",
    quote: int = QUOTE_CURRENCY,
    dedupe: bool = True,
    wide: bool = False,
) -> DataFrame:
    """The mart by day, currency and status; totals as in ``global_metrics``."""
    keys = ["date_update", "currency_code", "status"]
    totals = account_day_status_totals(transactions, wide=True)
    return _mart(totals, rates, keys, METRICS_BY_STATUS.fieldNames(), rate_rule, rounding, quote, dedupe, wide)


def metrics_for_day(transactions: DataFrame, rates: DataFrame, day: Day, **options: object) -> DataFrame:
    """The by-status mart of one day."""
    return global_metrics_by_status(
        filter_business_day(transactions, day),
        rates.where(F.col("date_update") == day_literal(day)),
        **options,
    )


def metrics_backfill(
    transactions: DataFrame, rates: DataFrame, first: Day, last: Day, **options: object
) -> DataFrame:
    """The by-status mart of a range of days, in one job.

    The day is a group key already, so all days share one scan and their
    tasks; running the days one by one would read the rates once per day.
    """
    return global_metrics_by_status(
        filter_days(transactions, first, last), filter_rate_days(rates, first, last), **options
    )


def metrics_ordered(metrics: DataFrame) -> DataFrame:
    """The mart in display order."""
    return metrics.orderBy("date_update", "currency_from")
