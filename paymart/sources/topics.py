"""Message topics, read in one go or as a stream.

``format="kafka"`` needs Spark's Kafka connector on the class path. Any other
format stands in for it as long as its rows have a binary ``value``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# Connector words for the two ends of a partition's log.
EARLIEST = -2
LATEST = -1

VALUE_SCHEMA = "value BINARY"


def partition_offsets(topic: str, partitions: Sequence[int], offset: int) -> str:
    """Offsets per partition in the connector's JSON form."""
    return json.dumps({topic: {str(p): offset for p in partitions}})


def topic_options(servers: str, topic: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Connection options; TLS and SASL settings pass through as ``extra``."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **(extra or {})}


def batch_options(options: Mapping[str, str], start: str, end: str) -> dict[str, str]:
    return {
        "failOnDataLoss": "false",
        **options,
        "startingOffsets": start,
        "endingOffsets": end,
    }


def stream_options(options: Mapping[str, str], start: str = "latest") -> dict[str, str]:
    return {"failOnDataLoss": "false", **options, "startingOffsets": start}


def read_messages_batch(
    spark: SparkSession,
    options: Mapping[str, str],
    start: str = "earliest",
    end: str = "latest",
    format: str = "kafka",
) -> DataFrame:
    """All messages between two offsets, over all partitions of the topic."""
    reader = spark.read.format(format)
    if format != "kafka":
        return reader.schema(VALUE_SCHEMA).options(**options).load()
    return reader.options(**batch_options(options, start, end)).load()


def read_messages_stream(
    spark: SparkSession,
    options: Mapping[str, str],
    start: str = "latest",
    format: str = "kafka",
) -> DataFrame:
    """Messages as they arrive."""
    reader = spark.readStream.format(format)
    if format != "kafka":
        return reader.schema(VALUE_SCHEMA).options(**options).load()
    return reader.options(**stream_options(options, start)).load()
