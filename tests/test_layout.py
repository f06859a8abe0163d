"""How stored files lie: compaction, days switched at once, buckets by sender, counts from footers."""

import subprocess
import sys
import textwrap
import threading

import pytest
from pyspark.sql import functions as F
from test_tables import D1, D2, D3, D4, metrics, stored, txns

from paymart.operators.totals import account_day_totals
from paymart.plans import ingest, mart
from paymart.schemas import TRANSACTION_TABLE
from paymart.sinks import bucketed, compaction, files, switched, tables

ROOT = __file__.rsplit("/tests/", 1)[0]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def compact(spark, path, **options):
    return compaction.compact(spark, path, TRANSACTION_TABLE, "business_dt", tables.TXN_SORT, **options)


def n_files(tmp_path, day):
    return len(list((tmp_path / "table" / f"business_dt={day}").glob("*.parquet")))


def test_packing_fills_groups_and_leaves_single_files():
    sizes = {"a": 60, "b": 50, "c": 40, "d": 30, "e": 99}
    groups = compaction.packed(sizes, 100)
    assert sorted(map(sorted, groups)) == [["a", "c"], ["b", "d"]]
    assert all(sum(sizes[n] for n in g) <= 100 for g in groups)
    assert compaction.packed({}, 100) == compaction.packed({"a": 5}, 100) == []


def test_many_small_loads_become_few_files(spark, tmp_path, path):
    for i in range(50):
        rows = txns(spark, (f"a{i}", D1, "done"), (f"b{i}", D2, "done")) if i < 5 else txns(spark, (f"a{i}", D1, "done"))
        tables.append_transactions(rows.coalesce(1), path)
    tables.append_transactions(txns(spark, ("c", D3, "done")), path)
    before = stored(spark, path)
    assert (n_files(tmp_path, D1), n_files(tmp_path, D2), n_files(tmp_path, D3)) == (50, 5, 1)
    assert compact(spark, path) == 53
    assert (n_files(tmp_path, D1), n_files(tmp_path, D2), n_files(tmp_path, D3)) == (1, 1, 1)
    assert stored(spark, path) == before
    assert compact(spark, path) == 0
    assert not list((tmp_path / "table.compaction").glob("*"))


def test_only_named_days_and_wanted_sizes(spark, tmp_path, path):
    for i in range(8):
        tables.append_transactions(txns(spark, (f"a{i}", D1, "done"), (f"b{i}", D2, "done")).coalesce(1), path)
    size = max(files.sizes(spark, f"{path}/*/*.parquet").values())
    assert compact(spark, path, only=[D2], file_bytes=3 * size) > 0
    assert n_files(tmp_path, D1) == 8 and 2 < n_files(tmp_path, D2) < 8
    assert len(stored(spark, path)) == 16


def test_a_compaction_that_stopped_is_finished_by_the_next(spark, tmp_path, path, monkeypatch):
    for i in range(6):
        tables.append_transactions(txns(spark, (f"a{i}", D1, "done")).coalesce(1), path)
    before = stored(spark, path)
    with monkeypatch.context() as m:
        left, delete = [3], files.delete

        def some(spark, name):  # the process ends after three old files are gone
            if not left[0]:
                raise KeyboardInterrupt
            left[0] -= 1
            delete(spark, name)

        m.setattr(files, "delete", some)
        with pytest.raises(KeyboardInterrupt):
            compact(spark, path)
    assert compaction.finish(spark, path) == 1
    assert stored(spark, path) == before and n_files(tmp_path, D1) == 1


def test_a_day_replaced_meanwhile_is_left_alone(spark, tmp_path, path, monkeypatch):
    for i in range(4):
        tables.append_transactions(txns(spark, (f"a{i}", D1, "done")).coalesce(1), path)
    listed, sizes = [], files.sizes

    def then_replaced(spark, pattern):
        if listed and pattern.startswith(path + "/"):
            tables.overwrite_by_day(txns(spark, ("new", D1, "done")), path, "business_dt", tables.TXN_SORT)
        listed.append(pattern) if pattern.startswith(path + "/") else None
        return sizes(spark, pattern)

    monkeypatch.setattr(files, "sizes", then_replaced)
    assert compact(spark, path) == 0
    assert stored(spark, path) == [("new", D1, "done")]


def shown(spark, path, days=None):
    return sorted((r["date_update"], r["amount_total"]) for r in switched.read_table(spark, path, days=days).collect())


def test_days_are_replaced_at_one_moment(spark, path):
    assert shown(spark, path) == []
    assert switched.replace_days(metrics(spark, (D1, 1), (D2, 2), (D3, 3)), path, [D1, D2, D3]) == 3
    assert switched.replace_days(metrics(spark, (D2, 20), (D4, 9)), path, [D2, D3]) == 1
    assert shown(spark, path) == [(D1, 1), (D2, 20)]
    assert shown(spark, path, days=[D1, D3]) == [(D1, 1)]
    switched.replace_days(metrics(spark, (D3, 7)), path, [D3])
    assert shown(spark, path) == [(D1, 1), (D2, 20), (D3, 7)]
    assert switched.replace_days(metrics(spark), path, []) == 0


def test_a_failure_between_two_days_shows_the_old_range(spark, path, monkeypatch):
    switched.replace_days(metrics(spark, (D1, 1), (D2, 2)), path, [D1, D2])
    write = switched.append_by_day

    def fails(df, *rest):
        write(df.where(F.col("date_update") == F.lit(D1)), *rest)
        raise OSError("lost")

    monkeypatch.setattr(switched, "append_by_day", fails)
    with pytest.raises(OSError):
        switched.replace_days(metrics(spark, (D1, 10), (D2, 20)), path, [D1, D2])
    assert shown(spark, path) == [(D1, 1), (D2, 2)]
    monkeypatch.setattr(switched, "append_by_day", write)
    switched.replace_days(metrics(spark, (D1, 10), (D2, 20)), path, [D1, D2])
    assert shown(spark, path) == [(D1, 10), (D2, 20)]


def test_writers_of_different_days_at_once(spark, path):
    """Four at a time, as the daily runs of the mart."""
    days = [D1, D2, D3, D4]
    for factor in (1, 10):
        jobs = [
            threading.Thread(target=switched.replace_days, args=(metrics(spark, (d, i * factor)), path, [d])) for i, d in enumerate(days)
        ]
        [j.start() for j in jobs]
        [j.join() for j in jobs]
        assert shown(spark, path) == [(d, i * factor) for i, d in enumerate(days)]


def test_a_reader_keeps_its_days_through_one_replacement(spark, path):
    switched.replace_days(metrics(spark, (D1, 1)), path, [D1])
    begun = switched.read_table(spark, path)
    switched.replace_days(metrics(spark, (D1, 2)), path, [D1])
    assert begun.first()["amount_total"] == 1
    switched.replace_days(metrics(spark, (D1, 3)), path, [D1])
    versions = files.folders(spark, f"{path}/version=*/date_update=*")
    assert len(versions) == 2 and shown(spark, path) == [(D1, 3)]


def test_many_switches_are_merged(spark, path, monkeypatch, tmp_path):
    monkeypatch.setattr(switched, "MOST_SWITCHES", 3)
    for n in range(9):
        switched.replace_days(metrics(spark, (D1, n), (D2, n)), path, [D1, D2] if n % 2 else [D1])
    assert len(list((tmp_path / "table" / "_switches").glob("days-*"))) <= 4
    assert shown(spark, path) == [(D1, 8), (D2, 7)]


def test_an_older_switch_that_comes_late_wins_nothing(spark, path):
    switched.replace_days(metrics(spark, (D1, 1)), path, [D1])
    switched._leave(spark, path, {"2022-10-01": [5, "gone", None]})
    assert shown(spark, path) == [(D1, 1)]


def test_update_mart_with_one_switch(spark, tmp_path):
    transactions, rates, target = (str(tmp_path / n) for n in ("transactions", "rates", "mart"))
    tables.append_transactions(txns(spark, ("1", D1, "done"), ("2", D2, "done")), transactions)
    rate = spark.sql("SELECT 430 AS currency_code, 420 AS currency_code_with, DATE '2022-10-02' AS date_update, 3.0BD AS currency_with_div")
    tables.load_rates(rate.withColumn("currency_with_div", F.col("currency_with_div").cast("decimal(18,6)")), rates)
    assert ingest.update_mart(spark, transactions, rates, target, D1, D3, replace=switched.replace_days) == 2
    assert shown(spark, target) == [(D1, 10), (D2, 30)]


def bucket_table(spark, tmp_path, rows, **options):
    database = f"paymart_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{tmp_path}/db'")
    bucketed.save_bucketed(rows, f"{database}.t", **options)
    return spark.table(f"{database}.t")


def many(spark, n, sender="CAST(id % 997 + 1 AS INT)"):
    return spark.range(n).selectExpr(
        "CAST(id AS STRING) AS operation_id", f"{sender} AS account_number_from", "2 AS account_number_to",
        "430 AS currency_code", "'A' AS country", "'done' AS status", "'t' AS transaction_type", "id AS amount",
        "TIMESTAMP_NTZ '2022-10-01 00:00:00' AS transaction_dt", "DATE '2022-10-01' + CAST(id % 5 AS INT) AS business_dt",
    )


def test_totals_of_a_bucketed_table_need_no_exchange(spark, tmp_path):
    rows = many(spark, 20_000)
    table = bucket_table(spark, tmp_path, rows, buckets=16)
    totals = account_day_totals(table)
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, account_day_totals(rows).collect()))
    metrics_plan = mart.global_metrics(table, _rates(spark))._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in metrics_plan.splitlines() if "Exchange" in line and "account_number_from" in line]


def _rates(spark):
    return spark.sql(
        "SELECT 430 AS currency_code, 420 AS currency_code_with, DATE '2022-10-01' AS date_update, CAST(2 AS DECIMAL(18,6)) AS currency_with_div"
    )


def test_bucketed_table_grows_and_has_one_file_a_day_and_bucket(spark, tmp_path):
    rows = many(spark, 3_000)
    for half in (0, 1):
        table = bucket_table(spark, tmp_path, rows.where(F.col("amount") % 2 == half), buckets=4)
    assert table.count() == 3_000
    assert len(files.sizes(spark, f"{tmp_path}/db/t/business_dt=2022-10-01/*.parquet")) == 8


def test_a_hot_sender_is_refused_before_anything_is_written(spark, tmp_path):
    hot = many(spark, 9_000, "IF(id % 3 = 0, 7, CAST(id % 997 + 1 AS INT))")
    with pytest.raises(bucketed.UnevenBucketsError):
        bucket_table(spark, tmp_path, hot, buckets=64)
    assert not spark.catalog.tableExists(f"paymart_{tmp_path.name.replace('-', '_')}.t")


def test_counts_are_those_of_committed_files(tmp_path):
    """A session that retries tasks, and a task that fails once after its rows are written."""
    code = textwrap.dedent(
        f"""
        import sys
        sys.path[:0] = [{ROOT!r}, {ROOT + "/tests"!r}]
        from paymart.session import get_session
        from paymart.schemas import TRANSACTION_TABLE
        from paymart.sinks import tables
        from pyspark import TaskContext
        spark = get_session("retry", **{{"spark.master": "local[2,4]", "spark.ui.enabled": "false", "spark.log.level": "OFF",
                                        "spark.sql.shuffle.partitions": 4}})
        rows = spark.range(1000).selectExpr(
            "CAST(id AS STRING) AS operation_id", "1 AS account_number_from", "2 AS account_number_to", "430 AS currency_code",
            "'A' AS country", "'done' AS status", "'t' AS transaction_type", "id AS amount",
            "TIMESTAMP_NTZ '2022-10-01 00:00:00' AS transaction_dt", "DATE '2022-10-01' AS business_dt")

        def once(batches):
            yield from batches
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")

        rows = rows.mapInArrow(once, rows.schema)
        tables._by_day = lambda df, day, sort_by: df  # no exchange between the failing task and the write
        print("counted", tables.append_transactions(rows, {str(tmp_path / "t")!r}))
        print("stored", tables.read_table(spark, {str(tmp_path / "t")!r}, TRANSACTION_TABLE).count())
        """
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "counted [1000]" in done.stdout and "stored 1000" in done.stdout, done.stdout + done.stderr[-2000:]


def test_counts_leave_out_what_others_write(spark, path):
    assert tables.append_transactions(txns(spark, ("1", D1, "done"), ("x", None, "done")), path) == [2]
    assert tables.append_transactions(txns(spark, ("2", D1, "done")), path) == [1]
    assert tables.rows_in_files(spark, files.sizes(spark, f"{path}/*/*.parquet")) == 3
