"""Writers: what is stored after first runs, reruns and replacements."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paymart.operators.upsert import new_rows, upsert_do_nothing, upsert_do_update
from paymart.plans import ingest
from paymart.schemas import METRICS_BY_STATUS, RATES, TRANSACTION_TABLE, TXN_COLUMNS
from paymart.sinks import tables
from paymart.sinks.files import MissingInputError
from paymart.sources.rates import bad_rates, good_rates, read_rates_csv

D1, D2, D3, D4 = (dt.date(2022, 10, d) for d in (1, 2, 3, 4))


def txns(spark, *specs):
    """Rows from (id, day, status)."""
    return spark.createDataFrame(
        [
            (i, 1, 2, 430, "A", status, "sbp_incoming", 10, day and dt.datetime(day.year, day.month, day.day, 9), day)
            for i, day, status in specs
        ],
        TRANSACTION_TABLE,
    )


def metrics(spark, *specs):
    return spark.createDataFrame(
        [(day, 430, total, 1, 1.0, 1, "done") for day, total in specs], METRICS_BY_STATUS
    )


def stored_metrics(spark, path):
    found = tables.read_table(spark, path, METRICS_BY_STATUS).orderBy("date_update", "amount_total").collect()
    return [(r["date_update"], r["amount_total"]) for r in found]


def stored(spark, path):
    found = tables.read_table(spark, path, TRANSACTION_TABLE).orderBy("operation_id", "business_dt").collect()
    return [(r["operation_id"], r["business_dt"], r["status"]) for r in found]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_table_never_written_is_empty(spark, path):
    assert tables.read_table(spark, path, TRANSACTION_TABLE, missing_ok=True).count() == 0
    with pytest.raises(MissingInputError):
        tables.read_table(spark, path, TRANSACTION_TABLE)


def test_reading_days_lists_no_others(spark, path):
    tables.append_transactions(txns(spark, ("1", D1, "done"), ("2", D2, "done"), ("x", None, "done")), path)
    found = tables.read_days(spark, path, TRANSACTION_TABLE, "business_dt", [D2, D3])
    assert [(r["operation_id"], r["business_dt"]) for r in found.collect()] == [("2", D2)]
    assert all("business_dt=2022-10-02" in f for f in found.inputFiles())
    assert tables.read_days(spark, path, TRANSACTION_TABLE, "business_dt", [D4]).count() == 0
    assert tables.read_days(spark, path, TRANSACTION_TABLE, "business_dt", []).count() == 0
    without = tables.read_days(spark, path, TRANSACTION_TABLE, "business_dt", [None]).collect()
    assert [(r["operation_id"], r["business_dt"]) for r in without] == [("x", None)]


def test_append_to_two_targets(spark, tmp_path):
    paths = [str(tmp_path / n) for n in "ab"]
    rows = txns(spark, ("1", D1, "done"), ("2", D2, "done")).select(*reversed(TRANSACTION_TABLE.fieldNames()))
    assert tables.append_transactions(rows, *paths) == [2, 2]
    assert stored(spark, paths[0]) == stored(spark, paths[1]) == [("1", D1, "done"), ("2", D2, "done")]
    assert (tmp_path / "a" / "business_dt=2022-10-01").is_dir()


def test_append_to_another_kind_of_target(spark, path):
    seen = []

    def other(df):
        seen.extend(df.columns)
        return df.count()

    assert tables.append_transactions(txns(spark, ("1", D1, "done")), path, others=[other]) == [1, 1]
    assert seen == TRANSACTION_TABLE.fieldNames()


def test_days_between():
    assert tables.days_between("2022-09-30", dt.datetime(2022, 10, 2, 5)) == [dt.date(2022, 9, 30), D1, D2]
    assert tables.days_between(D2, D1) == []


def test_append_reports_missing_columns(spark, path):
    with pytest.raises(ValueError, match="business_dt"):
        tables.append_transactions(txns(spark, ("1", D1, "done")).drop("business_dt"), path)


def test_write_count_of_no_rows(spark, path):
    assert tables.append_transactions(txns(spark), path) == [0]


def test_replace_days_twice_is_the_same(spark, path):
    rows = metrics(spark, (D1, 1), (D2, 2))
    for _ in range(2):
        assert tables.replace_days(rows, path, D1, D2) == 2
        assert stored_metrics(spark, path) == [(D1, 1), (D2, 2)]


def test_replaced_day_that_turns_empty_is_emptied(spark, path):
    tables.replace_days(metrics(spark, (D1, 1), (D2, 2), (D3, 3)), path, D1, D3)
    assert tables.replace_days(metrics(spark, (D3, 30)), path, D2, D3) == 1
    assert stored_metrics(spark, path) == [(D1, 1), (D3, 30)]
    assert tables.replace_days(metrics(spark), path, D1, D1) == 0
    assert stored_metrics(spark, path) == [(D3, 30)]
    tables.replace_days(metrics(spark, (D1, 7)), path, D1, D1)
    assert stored_metrics(spark, path) == [(D1, 7), (D3, 30)]


def test_replace_days_leaves_other_days_and_writes_none(spark, path):
    tables.append_metrics(metrics(spark, (D1, 1), (D4, 4)), path)
    tables.replace_days(metrics(spark, (D1, 9), (D2, 2), (D4, 9)), path, D2, D3)
    assert stored_metrics(spark, path) == [(D1, 1), (D2, 2), (D4, 4)]


def test_append_metrics_repeats_rows(spark, path):
    for _ in range(2):
        assert tables.append_metrics(metrics(spark, (D1, 1)), path) == 1
    assert stored_metrics(spark, path) == [(D1, 1), (D1, 1)]


def test_insert_new_skips_known_keys(spark, path):
    assert tables.insert_new(txns(spark, ("1", D1, "done")), path) == 1
    again = txns(spark, ("1", D1, "queued"), ("2", D1, "done"), ("2", D1, "done"), ("1", D2, "done"))
    assert tables.insert_new(again, path) == 2
    assert tables.insert_new(again, path) == 0
    assert stored(spark, path) == [("1", D1, "done"), ("1", D2, "done"), ("2", D1, "done")]


def test_insert_new_takes_the_last_of_several(spark, path):
    rows = txns(spark, ("1", D1, "done"), ("1", D1, "queued")).withColumn(
        "seen", F.when(F.col("status") == "done", 1).otherwise(2)
    )
    tables.insert_new(rows, path, order_by=["seen"])
    assert stored(spark, path) == [("1", D1, "queued")]


def test_insert_or_update_rewrites_only_the_days_at_hand(spark, tmp_path, path):
    tables.append_transactions(txns(spark, ("1", D1, "queued"), ("2", D1, "queued"), ("3", D2, "queued")), path)
    untouched = sorted((tmp_path / "table" / "business_dt=2022-10-02").iterdir())
    rows = txns(spark, ("1", D1, "done"), ("4", D3, "done"))
    for _ in range(2):
        assert tables.insert_or_update(rows, path) == 3
        assert stored(spark, path) == [
            ("1", D1, "done"),
            ("2", D1, "queued"),
            ("3", D2, "queued"),
            ("4", D3, "done"),
        ]
    assert sorted((tmp_path / "table" / "business_dt=2022-10-02").iterdir()) == untouched


def test_update_keeps_stored_rows_without_a_day(spark, path):
    tables.append_transactions(txns(spark, ("x", None, "done"), ("1", D1, "done")), path)
    tables.insert_or_update(txns(spark, ("y", None, "done"), ("1", D1, "queued")), path)
    assert stored(spark, path) == [("1", D1, "queued"), ("x", None, "done"), ("y", None, "done")]


def test_hot_day_is_written_by_several_tasks(spark, tmp_path, path):
    n = 90_000
    hot = spark.range(n).selectExpr(
        "CAST(id AS STRING) AS operation_id", "CAST(id AS INT) AS account_number_from", "2 AS account_number_to",
        "430 AS currency_code", "uuid() AS country", "'done' AS status", "'t' AS transaction_type", "id AS amount",
        "TIMESTAMP_NTZ '2022-10-01 00:00:00' + make_dt_interval(IF(id % 3 = 0, 0, id % 10)) AS transaction_dt",
    ).withColumn("business_dt", F.to_date("transaction_dt"))
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "256k")
    try:
        tables.append_transactions(hot.repartition(8), path)
    finally:
        spark.conf.set(setting, before)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "table").glob("business_dt=*")}
    assert len(files) == 10
    assert files["business_dt=2022-10-01"] > 3
    assert tables.read_table(spark, path, TRANSACTION_TABLE).count() == n


def test_null_keys_never_conflict(spark, rows):
    target = spark.createDataFrame([(None, "t"), ("a", "t")], "id STRING, v STRING")
    incoming = spark.createDataFrame([(None, "r"), (None, "r"), ("a", "r"), ("b", "r")], "id STRING, v STRING")
    assert rows(upsert_do_nothing(target, incoming, ["id"])) == sorted(
        [(None, "r"), (None, "r"), (None, "t"), ("a", "t"), ("b", "r")], key=lambda t: (t[0] is not None, str(t))
    )
    assert rows(upsert_do_update(target, incoming, ["id"])) == sorted(
        [(None, "r"), (None, "r"), (None, "t"), ("a", "r"), ("b", "r")], key=lambda t: (t[0] is not None, str(t))
    )


def test_update_with_null_and_with_a_missing_column(spark, rows):
    target = spark.createDataFrame([("a", "old", "kept"), ("c", "old", "kept")], "id STRING, v STRING, w STRING")
    incoming = spark.createDataFrame([("a", None), ("b", "new")], "id STRING, v STRING")
    found = upsert_do_update(target, incoming, ["id"])
    assert found.columns == ["id", "v", "w"]
    assert rows(found) == [("a", None, "kept"), ("b", "new", None), ("c", "old", "kept")]


def test_new_rows_reads_only_the_key_of_the_target(spark, path):
    tables.append_transactions(txns(spark, ("1", D1, "done")), path)
    target = tables.read_table(spark, path, TRANSACTION_TABLE).where("business_dt = '2022-10-01'")
    found = new_rows(target, txns(spark, ("2", D1, "done")), ["business_dt", "operation_id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<operation_id:string>" in plan
    assert "PartitionFilters: [isnotnull(business_dt" in plan


def test_rates_are_replaced_and_bad_lines_left_out(spark, tmp_path, path):
    file, rejects = tmp_path / "rates.csv", str(tmp_path / "rejects")
    file.write_text(
        "currency_code,currency_code_with,date_update,currency_with_div\n"
        "430,420,2022-10-01,1.5\n430,420,2022-10-01,1.5\nbad,420,2022-10-01,1\n440,420,2022-10-02,0\n"
    )
    csv = read_rates_csv(spark, str(file))
    assert [r["_corrupt_record"] for r in bad_rates(csv).collect()] == ["bad,420,2022-10-01,1"]
    assert good_rates(csv).select("date_update").where("date_update = '2022-10-01'").count() == 2
    for _ in range(2):
        assert ingest.ingest_rates(spark, str(file), path, rejects_path=rejects, most_bad=0.5) == [2]
    assert [r["line"] for r in spark.read.parquet(rejects).collect()] == ["bad,420,2022-10-01,1"]
    with pytest.raises(ingest.BadRatesError, match="1 of 4"):
        ingest.ingest_rates(spark, str(file), path)
    found = tables.read_rates(spark, path).orderBy("currency_code").collect()
    assert [tuple(r) for r in found] == [
        (430, 420, D1, Decimal("1.500000")),
        (440, 420, D2, Decimal("0.000000")),
    ]


def test_empty_rate_file_fails_before_anything_is_replaced(spark, tmp_path, path):
    full, empty = tmp_path / "full.csv", tmp_path / "empty.csv"
    header = "currency_code,currency_code_with,date_update,currency_with_div\n"
    full.write_text(header + "430,420,2022-10-01,1.5\n")
    empty.write_text(header)
    ingest.ingest_rates(spark, str(full), path)
    with pytest.raises(ValueError, match="no rows"):
        ingest.ingest_rates(spark, str(empty), path)
    assert tables.read_rates(spark, path).count() == 1


def test_rates_go_by_the_names_in_the_header(spark, tmp_path, path):
    file = tmp_path / "rates.csv"
    file.write_text("currency_code_with,remark,currency_code,currency_with_div,date_update\n420,x,430,1.5,2022-10-01\n")
    ingest.ingest_rates(spark, str(file), path)
    assert [tuple(r) for r in tables.read_rates(spark, path).collect()] == [(430, 420, D1, Decimal("1.500000"))]
    file.write_text("currency_code_with,currency_code,date_update\n420,430,2022-10-01\n")
    with pytest.raises(ValueError, match="currency_with_div"):
        ingest.ingest_rates(spark, str(file), path)


def test_conflicting_rates_fail_and_replace_nothing(spark, tmp_path, path):
    header = "currency_code,currency_code_with,date_update,currency_with_div\n"
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text(header + "430,420,2022-10-01,1.5\n")
    bad.write_text(header + "430,420,2022-10-01,2\n430,420,2022-10-01,3\n")
    ingest.ingest_rates(spark, str(good), path)
    with pytest.raises(ingest.ConflictingRatesError):
        ingest.ingest_rates(spark, str(bad), path)
    assert [r["currency_with_div"] for r in tables.read_rates(spark, path).collect()] == [Decimal("1.500000")]


def test_old_versions_of_rates_go(spark, tmp_path, path):
    for rate in (1, 2, 3):
        tables.load_rates(spark.createDataFrame([(430, 420, D1, Decimal(rate))], RATES), path)
        assert [r["currency_with_div"] for r in tables.read_rates(spark, path).collect()] == [Decimal(rate)]
    assert len(list((tmp_path / "table").glob("version-*"))) == 2


def test_empty_topic_fails(spark, path):
    with pytest.raises(ValueError, match="no rows"):
        ingest.ingest_messages(spark.createDataFrame([], "value BINARY"), path)


def test_update_mart_from_stored_tables(spark, tmp_path):
    transactions, rates, mart = (str(tmp_path / n) for n in ("transactions", "rates", "mart"))
    tables.append_transactions(txns(spark, ("1", D1, "done"), ("2", D2, "done"), ("3", D3, "done")), transactions)
    tables.load_rates(spark.createDataFrame([(430, 420, D2, Decimal(3))], RATES), rates)
    for _ in range(2):
        assert ingest.update_mart(spark, transactions, rates, mart, D1, D2) == 2
    assert stored_metrics(spark, mart) == [(D1, 10), (D2, 30)]


def test_wrong_paths_leave_the_mart_alone(spark, tmp_path):
    transactions, rates, mart, wrong = (str(tmp_path / n) for n in ("transactions", "rates", "mart", "wrong"))
    tables.append_transactions(txns(spark, ("1", D1, "done")), transactions)
    tables.load_rates(spark.createDataFrame([(430, 420, D1, Decimal(3))], RATES), rates)
    ingest.update_mart(spark, transactions, rates, mart, D1, D1)
    for one, two in ((wrong, rates), (transactions, wrong)):
        with pytest.raises(MissingInputError, match="wrong"):
            ingest.update_mart(spark, one, two, mart, D1, D1)
        assert stored_metrics(spark, mart) == [(D1, 30)]
    tables.load_rates(spark.createDataFrame([], RATES), rates)
    with pytest.raises(ValueError, match="no rows"):
        ingest.update_mart(spark, transactions, rates, mart, D1, D1)
    assert stored_metrics(spark, mart) == [(D1, 30)]


def test_newer_copies_win_in_any_order(spark, tmp_path):
    def sent(*specs):
        rows = txns(spark, *[(i, day, status) for i, day, status, _ in specs])
        hours = F.element_at(F.create_map(*[F.lit(x) for i, _, _, h in specs for x in (i, h)]), F.col("operation_id"))
        return rows.withColumn("sent_dttm", F.expr("TIMESTAMP_NTZ '2022-10-01 00:00:00'") + F.make_dt_interval(hours=hours))

    early, late = sent(("1", D1, "queued", 10), ("2", D2, "done", 10)), sent(("1", D1, "done", 11), ("3", D2, "done", 9))
    for name, order in (("a", (early, late)), ("b", (late, early))):
        path = str(tmp_path / name)
        for rows in (*order, *order):
            tables.insert_or_newer(rows, path, ingest.SENT)
        assert stored(spark, path) == [("1", D1, "done"), ("2", D2, "done"), ("3", D2, "done")]


def test_path_writers_feed_catalogue_tables(spark, tmp_path):
    database = f"paymart_{tmp_path.name.replace('-', '_')}"
    tables.create_tables(spark, database, str(tmp_path), {"metrics": (METRICS_BY_STATUS, "date_update")})
    tables.append_metrics(metrics(spark, (D1, 1), (D2, 2)), str(tmp_path / "metrics"))
    tables.sync_catalogue(spark, f"{database}.metrics")
    assert spark.table(f"{database}.metrics").count() == 2


def test_create_tables_twice(spark, tmp_path):
    database = f"paymart_{tmp_path.name.replace('-', '_')}"
    for _ in range(2):
        tables.create_tables(
            spark, database, str(tmp_path), {"transactions": (TRANSACTION_TABLE, "business_dt")}
        )
    table = f"{database}.transactions"
    assert [f.name for f in spark.table(table).schema] == [*TXN_COLUMNS, "business_dt"]
    spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=txns(spark, ("1", D1, "done")))
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["business_dt=2022-10-01"]
