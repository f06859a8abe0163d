"""Projections onto the columns and types of a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.functions.calendar import business_day
from paymart.schemas import LABEL_SUFFIX, RATES, TRANSACTION_TABLE, TXN_COLUMNS, TXN_DAY


def select_transaction_columns(df: DataFrame) -> DataFrame:
    return df.select(*TXN_COLUMNS)


def to_target_columns(df: DataFrame, target: Sequence[str]) -> DataFrame:
    """The columns of ``target``, found by name and put in its order."""
    missing = [c for c in target if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {', '.join(missing)}")
    return df.select(*target)


def conform_transaction(df: DataFrame, *also: str) -> DataFrame:
    """Types of the stored transaction: times cut to milliseconds, day added.

    Columns named in ``also`` come along as they are.

    A value that does not fit becomes NULL and shows up in
    ``not_null_report``; it does not stop the load.
    """
    millis = F.date_trunc("MILLISECOND", F.col("transaction_dt")).cast("timestamp_ntz")
    casts = [
        (millis if f.name == "transaction_dt" else F.col(f.name).try_cast(f.dataType)).alias(f.name)
        for f in TRANSACTION_TABLE
        if f.name != TXN_DAY
    ]
    return df.select(*casts, *also).withColumn(TXN_DAY, business_day("transaction_dt"))


def conform_rate(df: DataFrame) -> DataFrame:
    """Types of the stored rate."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RATES])


def currency_label(country: Column | str) -> Column:
    """The currency's name as the dashboard shows it."""
    return F.concat(F.col(country) if isinstance(country, str) else country, F.lit(LABEL_SUFFIX))
