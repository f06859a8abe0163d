"""Decoding, rejecting and encoding of single messages."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from paymart.functions import conform_transaction, decode_envelope, decode_payload, encode_messages
from paymart.functions.messages import parse_messages
from paymart.operators.checks import any_null, not_null_report, quarantine
from paymart.operators.dedup import dedup_by_id, one_per_key
from paymart.operators.filters import filter_message_type
from paymart.plans.ingest import rejected_messages, transactions_from_messages
from paymart.queries import stored
from paymart.schemas import TXN_COLUMNS
from paymart.sinks.files import MissingInputError


def payload(**changes):
    fields = {
        "operation_id": "a",
        "account_number_from": 1,
        "account_number_to": 2,
        "currency_code": 430,
        "country": "X",
        "status": "done",
        "transaction_type": "sbp_incoming",
        "amount": 100,
        "transaction_dt": "2022-10-01 10:00:00.123456",
    }
    return json.dumps({**fields, **changes})


def envelope(object_id="a", object_type="TRANSACTION", sent="2022-10-01 10:00:00", body=None):
    return json.dumps(
        {
            "object_id": object_id,
            "object_type": object_type,
            "sent_dttm": sent,
            "payload": payload(operation_id=object_id) if body is None else body,
        }
    )


def messages(spark, *texts):
    return spark.createDataFrame([(None if t is None else t.encode(),) for t in texts], "value BINARY")


def test_decode_keeps_only_the_parsed_fields(spark):
    df = messages(spark, envelope()).selectExpr("value", "1 AS other")
    assert decode_envelope(df).columns == ["object_id", "object_type", "sent_dttm", "payload"]
    assert decode_payload(decode_envelope(df)).columns == TXN_COLUMNS


def test_malformed_envelope_is_all_null_and_rejected(spark, rows):
    df = messages(spark, "not json", "", None, envelope())
    assert rows(decode_envelope(df), "object_id") == [(None,), (None,), (None,), ("a",)]
    good, bad = quarantine(df)
    assert good.count() == 1
    assert rows(bad, "reject_reason", "raw") == [("envelope", None), ("envelope", ""), ("envelope", "not json")]
    assert rows(transactions_from_messages(df), "operation_id") == [("a",)]


def test_malformed_payload_is_rejected_only_for_transactions(spark, rows):
    df = messages(spark, envelope(body="garbage"), envelope("b", "CURRENCY", body="other shape"))
    good, bad = quarantine(df)
    assert rows(bad, "reject_reason") == [("payload",)]
    assert rows(good, "e.object_id") == [("b",)]


def test_bad_fields_are_null_and_counted(spark, rows):
    body = payload(account_number_from=12.5, transaction_dt="yesterday")
    df = messages(spark, envelope(body=body))
    found = decode_payload(decode_envelope(df))
    assert rows(found, "account_number_from", "account_number_to", "transaction_dt") == [(None, 2, None)]
    report = dict(rows(not_null_report(found, TXN_COLUMNS)))
    assert report == {c: int(c in ("account_number_from", "transaction_dt")) for c in TXN_COLUMNS}
    assert rows(rejected_messages(df), "reject_reason") == [("null",)]
    assert transactions_from_messages(df).where(~any_null(TXN_COLUMNS)).count() == 0


def test_every_message_is_loaded_or_rejected(spark, rows):
    df = messages(
        spark,
        envelope("a"),
        envelope("b", body="garbage"),
        envelope("c", body=payload(amount=None)),
        envelope("d", "CURRENCY", body="other shape"),
        "{}",
    )
    assert rows(rejected_messages(df), "reject_reason") == [("envelope",), ("null",), ("payload",)]
    loaded = transactions_from_messages(df).where(~any_null(TXN_COLUMNS))
    assert rows(loaded, "operation_id") == [("a",)]


def test_amount_above_int32_is_kept(spark, rows):
    df = messages(spark, envelope(body=payload(amount=3_000_000_000)))
    assert rows(transactions_from_messages(df), "amount") == [(3_000_000_000,)]


def test_times_are_cut_to_milliseconds(spark, rows):
    found = transactions_from_messages(messages(spark, envelope()))
    assert rows(found, "transaction_dt", "business_dt") == [
        (dt.datetime(2022, 10, 1, 10, 0, 0, 123000), dt.date(2022, 10, 1))
    ]
    assert found.schema["transaction_dt"].dataType.typeName() == "timestamp_ntz"


def test_replayed_id_gives_one_row(spark, rows):
    df = messages(spark, envelope(), envelope(), envelope())
    assert rows(transactions_from_messages(df), "operation_id") == [("a",)]


def test_latest_copy_wins_whatever_the_order(spark, rows):
    old = envelope(sent="2022-10-01 10:00:00", body=payload(status="queued"))
    new = envelope(sent="2022-10-01 11:00:00", body=payload(status="done"))
    for texts in ([old, new], [new, old]):
        assert rows(transactions_from_messages(messages(spark, *texts)), "status") == [("done",)]


def test_messages_without_id_go_by_their_operation(spark, rows):
    texts = [envelope(None, body=payload(operation_id=i)) for i in ("x", "y", "y")]
    assert rows(transactions_from_messages(messages(spark, *texts)), "operation_id") == [("x",), ("y",)]


def test_id_shared_by_two_types_keeps_the_transaction(spark, rows):
    df = messages(spark, envelope("a", "CURRENCY", body="{}"), envelope("a"))
    assert dedup_by_id(decode_envelope(df)).count() == 2
    assert filter_message_type(dedup_by_id(decode_envelope(df))).count() == 1
    assert rows(transactions_from_messages(df), "operation_id") == [("a",)]


def test_one_per_key_is_deterministic_on_ties(spark, rows):
    data = [("k", 1, "x"), ("k", 1, "z"), ("k", 1, "y"), (None, 2, "n"), (None, 2, "m")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "id STRING, at INT, v STRING").repartition(3)
        assert rows(one_per_key(df, ["id"], ["at"])) == [(None, 2, "n"), ("k", 1, "z")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS id", "id AS at")
    found = one_per_key(df, ["id"], ["at"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
    assert found.count() == 20_001
    assert found.where("id = 'hot'").first()["at"] == 29_997


def test_encode_and_decode_round_trip(spark, rows):
    df = messages(spark, envelope("a"), envelope("b", body=payload(operation_id="b", country='quote " and \\')))
    stored = transactions_from_messages(df)
    again = transactions_from_messages(encode_messages(stored.select(*TXN_COLUMNS)))
    assert rows(again) == rows(stored)


def test_conform_nulls_what_does_not_fit(spark, rows):
    df = spark.createDataFrame(
        [("a", "9999999999", "2", "430", "X", "done", "t", "5", dt.datetime(2022, 10, 1))],
        "operation_id STRING, account_number_from STRING, account_number_to STRING, currency_code STRING, "
        "country STRING, status STRING, transaction_type STRING, amount STRING, transaction_dt TIMESTAMP_NTZ",
    )
    assert rows(conform_transaction(df), "account_number_from", "account_number_to") == [(None, 2)]


def test_a_derived_text_is_made_once_per_message(spark):
    made = spark.range(3).select(F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("value"))
    parsed = parse_messages(made)
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("sha2(") == 1
    assert sorted(tuple(r) for r in parsed.select("raw", "reject_reason").collect()) == sorted((r[0], "envelope") for r in made.collect())


def test_troubled_loads_read_one_topic(spark, sf_dir, monkeypatch):
    """All four loads read the written topic; none makes the messages anew."""
    read = []
    monkeypatch.setattr(stored.ingest, "ingest_messages", lambda messages, *paths: read.append(messages.inputFiles()))
    with pytest.raises(MissingInputError):  # nothing is loaded here
        stored.ingest_troubled_messages(spark, sf_dir)
    assert len(read) == 4 and all("/topic-" in name for names in read for name in names)
