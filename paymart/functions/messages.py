"""JSON messages: an envelope whose payload is JSON text again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paymart.schemas import ENVELOPE, JSON_TIME, MESSAGE_TYPE, TRANSACTION, TXN_COLUMNS


def decode_json(df: DataFrame, field: str, schema: StructType | str) -> DataFrame:
    """Parse one column as JSON and keep nothing but the parsed fields."""
    parsed = F.from_json(F.col(field).cast("string"), schema)
    return df.select(parsed.alias("parsed")).select("parsed.*")


def decode_envelope(df: DataFrame, field: str = "value") -> DataFrame:
    return decode_json(df, field, ENVELOPE)


def decode_payload(df: DataFrame, field: str = "payload") -> DataFrame:
    return decode_json(df, field, TRANSACTION)


def _all_null(struct: str, schema: StructType) -> Column:
    """True where parsing gave nothing; covers the NULL struct of empty text."""
    return reduce(lambda a, b: a & b, [F.col(f"{struct}.{f}").isNull() for f in schema.fieldNames()])


def parse_messages(df: DataFrame, field: str = "value", message_type: str = MESSAGE_TYPE) -> DataFrame:
    """Both decodes in one pass, with the raw text and a verdict for each row.

    ``reject_reason`` is ``envelope`` or ``payload`` where that part did not
    parse, ``type`` for an envelope that does not say what it holds, and NULL
    otherwise. Payloads of other message types have another shape, so they are
    not judged.

    Each parse sits in a generator of one row. The verdict reads every parsed
    field, and a filter on it would otherwise be pushed down together with one
    copy of the parse per field. So does the text, which may be derived by a
    dear expression: a generator evaluates each of its columns by itself.
    """
    texts = df.select(_once(F.col(field).cast("string").alias("raw")))
    opened = texts.select(_once("raw", F.from_json("raw", ENVELOPE).alias("e")))
    parsed = opened.select(_once("raw", "e", F.from_json("e.payload", TRANSACTION).alias("t")))
    reason = (
        F.when(_all_null("e", ENVELOPE), F.lit("envelope"))
        .when(F.col("e.object_type").isNull(), F.lit("type"))
        .when((F.col("e.object_type") == message_type) & _all_null("t", TRANSACTION), F.lit("payload"))
    )
    return parsed.select("raw", "e", "t", reason.alias("reject_reason"))


def _once(*columns: Column | str) -> Column:
    return F.inline(F.array(F.struct(*columns)))


def _as_text(df: DataFrame, column: str) -> Column:
    if df.schema[column].dataType.typeName().startswith("timestamp"):
        return F.date_format(column, JSON_TIME).alias(column)
    return F.col(column)


def encode_json(df: DataFrame, columns: Sequence[str], name: str = "payload") -> DataFrame:
    """Add a column with the given columns as one JSON text."""
    return df.withColumn(name, F.to_json(F.struct(*[_as_text(df, c) for c in columns])))


def encode_envelope(df: DataFrame) -> DataFrame:
    """Envelope columns to the binary ``value`` a topic carries."""
    wrapped = encode_json(df, ENVELOPE.fieldNames(), "value")
    return wrapped.select(F.col("value").cast("binary").alias("value"))


def encode_messages(transactions: DataFrame, message_type: Column | str = MESSAGE_TYPE) -> DataFrame:
    """Transactions as topic messages, envelope included."""
    kind = F.lit(message_type) if isinstance(message_type, str) else message_type
    enveloped = encode_json(transactions, TXN_COLUMNS).select(
        F.col("operation_id").alias("object_id"),
        kind.alias("object_type"),
        F.col("transaction_dt").alias("sent_dttm"),
        "payload",
    )
    return encode_envelope(enveloped)
