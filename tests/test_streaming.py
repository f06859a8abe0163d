"""Streams over file sources, one file per micro-batch."""

import datetime as dt
import os

import pytest
from test_messages import envelope, payload

from paymart.functions import decode_envelope
from paymart.plans.ingest import ingest_messages
from paymart.schemas import TRANSACTION_TABLE
from paymart.sinks.tables import read_table
from paymart.sources.topics import read_messages_stream
from paymart.streaming import messages as stream


class Topic:
    """A folder whose files are read one by one in the order they were added."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0
        (root / "topic").mkdir()

    def add(self, *texts):
        self.n += 1
        frame = self.spark.createDataFrame([(t.encode(),) for t in texts], "value BINARY").coalesce(1)
        staged = self.root / f"staged{self.n}"
        frame.write.parquet(str(staged))
        [file] = staged.glob("part-*.parquet")
        target = self.root / "topic" / f"{self.n:03d}.parquet"
        target.write_bytes(file.read_bytes())
        stamp = 1_600_000_000 + self.n * 60
        os.utime(target, (stamp, stamp))

    def read(self):
        options = {"path": str(self.root / "topic"), "maxFilesPerTrigger": "1"}
        return read_messages_stream(self.spark, options, format="parquet")

    def run(self, df, name="out"):
        query = stream.stream_to_files(df, str(self.root / name), str(self.root / f"{name}-progress"))
        query.awaitTermination()
        return self.spark.read.schema(df.schema).parquet(str(self.root / name)), query


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def at(hour, object_id="a"):
    return envelope(object_id, sent=f"2022-10-01 {hour:02d}:00:00")


def test_decode_follows_the_batch_functions(topic, rows):
    topic.add(envelope("a"), "not json", envelope("b", "CURRENCY"))
    topic.add(envelope("c"))
    found, _ = topic.run(stream.stream_decode(topic.read()))
    assert rows(found, "operation_id") == [("a",), ("c",)]
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in TRANSACTION_TABLE]


def test_stream_goes_on_where_it_stopped(topic, rows):
    topic.add(envelope("a"))
    topic.run(stream.stream_decode(topic.read()))
    topic.add(envelope("b"))
    found, _ = topic.run(stream.stream_decode(topic.read()))
    assert rows(found, "operation_id") == [("a",), ("b",)]


def test_global_dedup_never_forgets(topic, rows):
    topic.add(at(1), at(1))
    topic.add(at(10, "b"))
    topic.add(at(11, "c"))
    topic.add(at(12))
    found, query = topic.run(stream.stream_dedup_global(decode_envelope(topic.read())))
    assert rows(found, "object_id") == [("a",), ("b",), ("c",)]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3


def test_bounded_dedup_forgets_after_the_delay(topic, rows):
    topic.add(at(1), at(1))
    topic.add(at(1))
    topic.add(at(10, "b"))
    topic.add(at(11, "c"))
    topic.add(at(12))
    found, query = topic.run(stream.stream_dedup_bounded(decode_envelope(topic.read())))
    assert rows(found, "object_id") == [("a",), ("a",), ("b",), ("c",)]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 4


def test_late_row_is_dropped_by_the_bounded_form_alone(topic, rows):
    topic.add(at(10, "b"))
    topic.add(at(11, "c"))
    topic.add(at(11, "d"))
    topic.add(at(1, "late"))
    bounded, query = topic.run(stream.stream_dedup_bounded(decode_envelope(topic.read())), "bounded")
    assert rows(bounded, "object_id") == [("b",), ("c",), ("d",)]
    endless, _ = topic.run(stream.stream_dedup_global(decode_envelope(topic.read())), "endless")
    assert rows(endless, "object_id") == [("b",), ("c",), ("d",), ("late",)]


def test_upsert_equals_the_batch_load(spark, topic, tmp_path, rows):
    topic.add(envelope("a"), envelope("a"), envelope("b", body=payload(operation_id="b", amount=5)))
    topic.add(at(1), "not json", envelope("c", "CURRENCY"))
    topic.add(envelope("d", body=payload(operation_id="d", transaction_dt="2022-10-02 00:00:00.000000")))
    topic.add(envelope("b", body=payload(operation_id="b", amount=5)))
    topic.add(at(9, "e").replace("queued", "blocked"), at(8, "f"))
    topic.add(at(10, "e"), at(7, "f").replace("queued", "blocked"))
    streamed, loaded = str(tmp_path / "streamed"), str(tmp_path / "loaded")
    for run in range(2):
        stream.stream_upsert(topic.read(), streamed, str(tmp_path / f"progress{run}")).awaitTermination()
    ingest_messages(spark.read.schema("value BINARY").parquet(str(tmp_path / "topic")), loaded)
    found = read_table(spark, streamed, TRANSACTION_TABLE)
    assert rows(found) == rows(read_table(spark, loaded, TRANSACTION_TABLE))
    assert rows(found.where("operation_id < 'e'"), "operation_id", "business_dt") == [
        ("a", dt.date(2022, 10, 1)),
        ("b", dt.date(2022, 10, 1)),
        ("d", dt.date(2022, 10, 2)),
    ]


def test_upsert_keeps_rejects_per_batch(spark, topic, tmp_path, rows):
    topic.add(envelope("a"), "not json")
    topic.add(envelope("b", body="garbage"))
    rejects = str(tmp_path / "rejects")
    query = stream.stream_upsert(topic.read(), str(tmp_path / "t"), str(tmp_path / "progress"), rejects)
    query.awaitTermination()
    assert rows(spark.read.parquet(rejects), "batch", "reject_reason") == [(0, "envelope"), (1, "payload")]


def test_batch_with_only_other_types_loads_nothing(spark, topic, tmp_path):
    topic.add(envelope("c", "CURRENCY"))
    stream.stream_upsert(topic.read(), str(tmp_path / "t"), str(tmp_path / "progress")).awaitTermination()
    assert read_table(spark, str(tmp_path / "t"), TRANSACTION_TABLE, missing_ok=True).count() == 0


def test_far_event_times_stop_nothing(topic, rows):
    for year in ("0001", "2300", "9999"):
        topic.add(envelope(year, sent=f"{year}-10-01 01:00:00"), at(1))
    for name, dedup in (("g", stream.stream_dedup_global), ("b", stream.stream_dedup_bounded)):
        found, _ = topic.run(dedup(decode_envelope(topic.read())), name)
        assert {r[0] for r in rows(found, "object_id")} >= {"a", "9999"}
