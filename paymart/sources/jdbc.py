"""Relational tables over JDBC; needs the database's driver on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    table: str,
    settings: Mapping[str, str],
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. With a partition column the table is read in parallel.

    The bounds only set the stride; rows outside them are read as well.
    """
    options = {"dbtable": table, "fetchsize": str(fetch_size), **settings}
    if partition_column is not None:
        if lower is None or upper is None or num_partitions is None:
            raise ValueError("a partitioned read needs lower, upper and num_partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(num_partitions),
        }
    return options


def read_table_jdbc(
    spark: SparkSession, table: str, settings: Mapping[str, str], **partitioning: object
) -> DataFrame:
    """A whole table; filters and column choices on the result go to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(table, settings, **partitioning)).load()
