"""Small helpers of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> tuple[dict[str, Query], Callable[[Query], Query]]:
    """A dictionary of queries and the decorator that fills it by function name."""
    found: dict[str, Query] = {}

    def register(query: Query) -> Query:
        found[query.__name__] = query
        return query

    return found, register


def plain_times(df: DataFrame) -> DataFrame:
    """Times with a zone to UTC wall time, the form the SQL side has."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
            for f in df.schema
        ]
    )


def as_text(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("value").cast("string").alias("value"))
