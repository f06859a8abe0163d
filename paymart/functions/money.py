"""Conversion and rounding of money, exact throughout.

Amounts are whole minor units (BIGINT) and rates DECIMAL(18,6), so a sum does
not depend on the order in which a shuffle delivers its rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _one() -> Column:
    return F.lit(1).cast("decimal(18,6)")


def rate_positive_else_one(rate: Column | str) -> Column:
    """The rate if it is above zero; 1 for a missing, zero or negative one."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    return F.when(rate > 0, rate).otherwise(_one())


def rate_coalesce_one(rate: Column | str) -> Column:
    """The rate if there is one, else 1; a zero rate stays zero."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    return F.coalesce(rate, _one())


RATE_RULES = {
    "positive_else_one": rate_positive_else_one,
    "coalesce_one": rate_coalesce_one,
}


def convert_amount(amount: Column | str, rate: Column | str) -> Column:
    """Minor units times rate; the result stays in minor units.

    DECIMAL(28,0) holds any BIGINT and the sum of 10^9 of the largest ones; the product is DECIMAL(38,6), exact or an error, never rounded.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    rate = F.col(rate) if isinstance(rate, str) else rate
    return amount.cast("decimal(28,0)") * rate


def round_whole(value: Column | str, rounding: str = "half_even") -> Column:
    """Round to a whole number, ties to even or away from zero."""
    if rounding == "half_even":
        return F.bround(value, 0)
    if rounding == "half_up":
        return F.round(value, 0)
    raise ValueError(f"unknown rounding {rounding!r}")


def round_total(value: Column | str, rounding: str = "half_even") -> Column:
    """A rounded money total, as BIGINT."""
    return round_whole(value, rounding).cast("bigint")


def round_average(value: Column | str, rounding: str = "half_even") -> Column:
    """A rounded average; it stays DOUBLE."""
    return round_whole(value, rounding)
