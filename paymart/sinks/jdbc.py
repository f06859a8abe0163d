"""A relational store as a target; needs the database's driver on the class path."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def jdbc_write_options(
    table: str, settings: Mapping[str, str], connections: int = 8, batch_size: int = 10_000
) -> dict[str, str]:
    """Writer options; never more tasks write at once than ``connections``."""
    return {
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        **settings,
    }


def jdbc_writer(table: str, settings: Mapping[str, str], **options: int) -> Callable[[DataFrame], int]:
    """A target for ``append_transactions`` and ``to_targets``: executors insert in batches.

    Columns are matched by name. A task that is repeated inserts its rows
    again, so give the table a unique key or load it through a staging table.
    """

    def write(df: DataFrame) -> int:
        counted = Observation()
        (
            df.observe(counted, F.count(F.lit(1)).alias("n"))
            .write.format("jdbc")
            .mode("append")
            .options(**jdbc_write_options(table, settings, **options))
            .save()
        )
        return counted.get.get("n") or 0

    return write
