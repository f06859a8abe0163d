"""Option builders, listings and checks that need no outside system."""

import json

import pytest

from paymart.operators.checks import domain_report, int_range_report, unique_key_report
from paymart.session import scratch_path, shared_dir
from paymart.sinks.jdbc import jdbc_write_options
from paymart.sources import jdbc, objects, topics
from paymart.sources.sqlfile import run_sql_file


def test_topic_options():
    options = topics.topic_options("h:9091", "t", {"kafka.security.protocol": "SASL_SSL"})
    assert options == {
        "kafka.bootstrap.servers": "h:9091",
        "subscribe": "t",
        "kafka.security.protocol": "SASL_SSL",
    }
    whole = topics.batch_options(options, "earliest", "latest")
    assert whole["startingOffsets"] == "earliest" and whole["endingOffsets"] == "latest"
    assert whole["failOnDataLoss"] == "false"
    assert topics.batch_options({"failOnDataLoss": "true"}, "earliest", "latest")["failOnDataLoss"] == "true"
    assert topics.stream_options(options)["startingOffsets"] == "latest"
    assert "endingOffsets" not in topics.stream_options(options)


def test_partition_offsets():
    text = topics.partition_offsets("t", [0, 1], topics.LATEST)
    assert json.loads(text) == {"t": {"0": -1, "1": -1}}


def test_jdbc_options():
    settings = {"url": "jdbc:postgresql://h/db", "driver": "org.postgresql.Driver"}
    assert jdbc.jdbc_options("public.transactions", settings) == {
        "dbtable": "public.transactions",
        "fetchsize": "10000",
        **settings,
    }
    parallel = jdbc.jdbc_options("t", settings, "transaction_dt", "2022-10-01", "2022-11-01", 64)
    assert parallel["partitionColumn"] == "transaction_dt"
    assert (parallel["lowerBound"], parallel["upperBound"], parallel["numPartitions"]) == (
        "2022-10-01",
        "2022-11-01",
        "64",
    )
    with pytest.raises(ValueError, match="numPartitions|num_partitions"):
        jdbc.jdbc_options("t", settings, "transaction_dt")


def test_jdbc_write_options():
    settings = {"url": "jdbc:postgresql://h/db"}
    assert jdbc_write_options("t", settings, connections=3) == {
        "dbtable": "t",
        "numPartitions": "3",
        "batchsize": "10000",
        "url": "jdbc:postgresql://h/db",
    }


def test_list_and_profile(spark, tmp_path):
    for name, n in (("a", 3), ("b", 5)):
        spark.range(n).selectExpr("id", "id * 2 AS twice").coalesce(1).write.parquet(str(tmp_path / name))
    listed = objects.list_objects(spark, str(tmp_path), "*.parquet")
    assert listed.columns == ["path", "modificationTime", "length"]
    assert listed.count() == 2
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    profile = objects.profile_source(spark.read.parquet(str(tmp_path / "a"), str(tmp_path / "b")))
    assert sorted((r["n_rows"], r["n_columns"]) for r in profile.collect()) == [(3, 2), (5, 2)]


def test_preview_is_ordered(spark):
    found = objects.preview(spark.range(100).repartition(7), ["id"], 3)
    assert [r["id"] for r in found.collect()] == [0, 1, 2]


def test_sql_file_binds_parameters_as_values(spark, tmp_path):
    file = tmp_path / "q.sql"
    file.write_text("SELECT id FROM {ids} WHERE CAST(id AS STRING) = :wanted")
    assert run_sql_file(spark, str(file), {"wanted": "3"}, ids=spark.range(9)).collect() == [(3,)]
    assert run_sql_file(spark, str(file), {"wanted": "3' OR '1' = '1"}, ids=spark.range(9)).collect() == []


def test_domain_report(spark, rows):
    df = spark.createDataFrame([("done", "x"), ("lost", "x"), ("lost", "y"), (None, "x")], "s STRING, t STRING")
    found = domain_report(df, {"s": ["done"], "t": ["x"]})
    assert rows(found) == [("s", None, 1), ("s", "lost", 2), ("t", "y", 1)]


def test_int_range_report(spark, rows):
    df = spark.createDataFrame([(2**31 - 1,), (2**31,), (-(2**31) - 5,), (None,)], "v BIGINT")
    assert rows(int_range_report(df, ["v"])) == [("v", 2, -(2**31) - 5, 2**31)]


def test_unique_key_report(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a INT, b INT")
    assert rows(unique_key_report(df, ["a", "b"])) == [(1, 1, 2)]


def test_scratch_paths_lie_in_the_shared_folder_and_differ(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_dir(spark))


class _Unset:
    """A session whose cluster names no shared folder."""

    def __init__(self, master):
        self.kept = {}
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.checkpoint = None

    def get(self, key, default=None):
        return self.kept.get(key, default)

    def set(self, key, value):
        self.kept[key] = value

    def setCheckpointDir(self, path):
        self.checkpoint = path

    def getCheckpointDir(self):
        return self.checkpoint


def test_shared_folder_is_required_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Unset("yarn"))
    local = _Unset("local[2]")
    assert shared_dir(local) == local.checkpoint == shared_dir(local)
