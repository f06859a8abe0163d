"""Queries over the message stream, run until all that is there is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart import fixtures, functions
from paymart.queries.shaping import as_text, plain_times, registry
from paymart.schemas import TRANSACTION_TABLE
from paymart.session import scratch_path
from paymart.sinks import tables, topics
from paymart.sources.topics import read_messages_stream as read_stream
from paymart.streaming import messages as stream

QUERIES, register = registry()


def _run(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "progress")
    stream.stream_to_files(df, path, checkpoint).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return functions.decode_envelope(fixtures.message_stream(spark, sf_dir))


@register
def read_messages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "topic")
    topics.produce_messages(fixtures.messages(spark, sf_dir), {"path": path}, format="parquet")
    return as_text(_run(read_stream(spark, {"path": path}, format="parquet")))


@register
def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(stream.stream_decode(fixtures.message_stream(spark, sf_dir)))


@register
def watermark_60m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(_run(stream.watermark_60m(_envelopes(spark, sf_dir))))


@register
def stream_dedup_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(_run(stream.stream_dedup_global(_envelopes(spark, sf_dir))))


@register
def stream_dedup_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(_run(stream.stream_dedup_bounded(_envelopes(spark, sf_dir))))


@register
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream loaded twice, the second time from its start."""
    path = scratch_path(spark, "transactions")
    for _ in range(2):
        messages = fixtures.message_stream(spark, sf_dir)
        stream.stream_upsert(messages, path, scratch_path(spark, "progress")).awaitTermination()
    return tables.read_table(spark, path, TRANSACTION_TABLE)


def _far_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth message has an event time in the year 9999."""
    far = F.col("sent_dttm").isNotNull() & (F.pmod(F.xxhash64("object_id"), F.lit(50)) == 0)
    time = F.when(far, F.lit("9999-12-31 10:00:00").cast("timestamp")).otherwise(F.col("sent_dttm"))
    return _envelopes(spark, sf_dir).withColumn("sent_dttm", time)


@register
def stream_dedup_global_far_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _run(stream.stream_dedup_global(_far_times(spark, sf_dir)))
    return found.select("object_id", "object_type", "payload")


@register
def stream_dedup_bounded_far_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _run(stream.stream_dedup_bounded(_far_times(spark, sf_dir)))
    return found.select("object_id", "object_type", "payload")


@register
def stream_upsert_troubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "transactions")
    messages = fixtures.troubled_messages(spark, sf_dir, stream=True)
    stream.stream_upsert(messages, path, scratch_path(spark, "progress")).awaitTermination()
    return tables.read_table(spark, path, TRANSACTION_TABLE)
