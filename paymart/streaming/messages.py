"""Streaming forms of decode, dedup and load.

The row-wise functions are those of the batch side. The stateful ones keep
one entry per id: ``dedup_global`` for ever, ``dedup_bounded`` until the
watermark has passed. The one to use for loading is ``stream_upsert``: its
memory is the target table, so it neither forgets nor grows, and each
micro-batch is reduced before it is shuffled.

State of ``dedup_global`` has no bound: it is for streams known to end. All
copies of one id travel to one task, as Spark does not combine before the
state; for topics that repeat an id without end, use ``stream_upsert``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from paymart.functions.columns import conform_transaction
from paymart.functions.messages import decode_envelope, decode_payload
from paymart.operators.filters import filter_message_type
from paymart.plans.ingest import load_messages
from paymart.schemas import EVENT_TIME, EVENT_TIME_DELAY

MESSAGE_KEY = ("object_type", "object_id")


def stream_decode(messages: DataFrame) -> DataFrame:
    """Raw messages to transactions, as they come."""
    return conform_transaction(decode_payload(filter_message_type(decode_envelope(messages))))


def watermark_60m(messages: DataFrame, delay: str = EVENT_TIME_DELAY) -> DataFrame:
    """Event time and allowed lateness; has to come before the stateful step."""
    return messages.withWatermark(EVENT_TIME, delay)


def stream_dedup_global(messages: DataFrame, key: Sequence[str] = MESSAGE_KEY) -> DataFrame:
    """One message per id over the whole life of the stream; state only grows."""
    return watermark_60m(messages.dropDuplicates(list(key)))


def stream_dedup_bounded(
    messages: DataFrame, key: Sequence[str] = MESSAGE_KEY, delay: str = EVENT_TIME_DELAY
) -> DataFrame:
    """One message per id within the delay; state is dropped after it.

    An id that comes again later is let through: pair it with an upsert.
    """
    return watermark_60m(messages, delay).dropDuplicatesWithinWatermark(list(key))


def stream_to_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is available now to files, then stop."""
    return (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def stream_upsert(
    messages: DataFrame, path: str, checkpoint: str, rejects_path: str | None = None
) -> StreamingQuery:
    """Load a message stream into the transactions table, each one once.

    Of several copies the last sent stays, in whichever micro-batches they
    come, so the table equals that of one batch load. A micro-batch that is
    repeated after a failure changes nothing, and rewrites its own rejects.
    The checkpoint keeps the offsets: a next run reads only what is new.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        rejects = f"{rejects_path}/batch={batch_id}" if rejects_path else None
        load_messages(batch, path, rejects_path=rejects)

    return (
        messages.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
