"""Rates and currency names, and the two joins of the mart.

No join here carries a broadcast hint. Spark broadcasts a side only after
comparing its size with ``spark.sql.autoBroadcastJoinThreshold``: from
statistics when planning, from the bytes actually shuffled when running.
Beyond the threshold it stays a sort-merge join, whose skewed partitions the
adaptive plan splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.functions.columns import currency_label
from paymart.functions.money import RATE_RULES
from paymart.operators.filters import filter_quote_currency
from paymart.schemas import QUOTE_CURRENCY


def dedupe_rates(rates: DataFrame) -> DataFrame:
    """One row where the same rate was loaded several times.

    Rows that disagree on the rate all stay; ``unique_key_report`` shows them.
    """
    return rates.dropDuplicates()


def rate_lookup(
    rates: DataFrame,
    rate_rule: str = "positive_else_one",
    quote: int = QUOTE_CURRENCY,
    dedupe: bool = True,
) -> DataFrame:
    """One row per day and currency, whatever the rates hold.

    A join with several rates for one key multiplies rows. Summing the rates
    and counting them first gives the same totals without the multiplication:
    sum(amount x r1) + sum(amount x r2) = sum(amount) x (r1 + r2).
    """
    quoted = filter_quote_currency(rates, quote)
    if dedupe:
        quoted = dedupe_rates(quoted)
    effective = RATE_RULES[rate_rule](F.col("currency_with_div"))
    return quoted.groupBy("date_update", "currency_code").agg(
        F.sum(effective).alias("rate_sum"), F.count(F.lit(1)).alias("n_rates")
    )


def join_rates(totals: DataFrame, rates: DataFrame, quote: int = QUOTE_CURRENCY) -> DataFrame:
    """Every total, with its rate where there is one."""
    quoted = dedupe_rates(filter_quote_currency(rates, quote))
    return totals.join(quoted, ["date_update", "currency_code"], "left")


def join_currency_names(metrics: DataFrame, names: DataFrame) -> DataFrame:
    """Metrics with the country of their currency.

    A currency without a name drops out, one with two countries appears twice.
    """
    labelled = names.select(
        F.col("currency_code").alias("currency_from"),
        currency_label("country").alias("currency_name"),
    )
    return metrics.join(labelled, "currency_from", "inner")
