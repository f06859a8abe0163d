"""Rows back into a topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from paymart.functions.columns import select_transaction_columns
from paymart.functions.messages import encode_messages


def produce_messages(messages: DataFrame, options: Mapping[str, str], format: str = "kafka") -> None:
    """Write a frame with a binary ``value``; executors send, each its own rows.

    Options of the Kafka form are the servers and ``topic``; any file format
    with a ``path`` stands in for it.
    """
    messages.select("value").write.format(format).mode("append").options(**options).save()


def replay_table_to_topic(table: DataFrame, options: Mapping[str, str], format: str = "kafka") -> None:
    """Stored transactions as messages, in the envelope the readers expect."""
    produce_messages(encode_messages(select_transaction_columns(table)), options, format)
