"""Transactions placed by sender, so that per-account totals need no exchange.

A catalogue table by day and by hash of the sender: all rows of an account lie in
the files of one bucket. Spark reads a bucket of all days at hand in one task and
aggregates it there; the mart then exchanges cells alone.

A bucket cannot be split. The write therefore counts the rows of each bucket
first and refuses a bucket that holds far more than the others, as a sender with
a third of all rows makes it: the plain layout, in which such a sender is
combined in every task before the exchange, is the right one there. Choose the
number of buckets so that a bucket of the days read together fits a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.functions.columns import to_target_columns
from paymart.schemas import TRANSACTION_TABLE, TXN_DAY

SENDER = "account_number_from"
BUCKETS = 256
UNEVEN = 4.0  # times the average that a bucket may hold


class UnevenBucketsError(ValueError):
    """A bucket that would make one task do the work of many."""


def bucket_rows(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Number of rows per bucket, as a bucketed write would place them."""
    bucket = F.pmod(F.hash(SENDER), F.lit(buckets)).alias("bucket")
    return rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n_rows"))


def save_bucketed(rows: DataFrame, table: str, buckets: int = BUCKETS, uneven: float = UNEVEN) -> None:
    """Append to a catalogue table by day and sender; made if it is not there.

    One file per day and bucket that has rows, sorted by sender. Raises
    ``UnevenBucketsError``, and writes nothing, if a bucket holds more than
    ``uneven`` times the average of all.
    """
    rows = to_target_columns(rows, TRANSACTION_TABLE.fieldNames())
    size = bucket_rows(rows, buckets).agg(F.max("n_rows").alias("largest"), F.sum("n_rows").alias("total")).first()
    if size["total"] and size["largest"] > max(uneven * size["total"] / buckets, 1):
        raise UnevenBucketsError(f"{table}: a bucket has {size['largest']} of {size['total']} rows")
    # Rows are dealt by the same hash as the buckets: each task holds one.
    (
        rows.repartition(buckets, SENDER)
        .sortWithinPartitions(TXN_DAY, SENDER)
        .write.partitionBy(TXN_DAY)
        .bucketBy(buckets, SENDER)
        .sortBy(SENDER)
        .mode("append")
        .saveAsTable(table, format="parquet")
    )
