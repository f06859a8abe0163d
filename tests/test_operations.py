"""Loads by operation: the key index, moved operations, changed days, Bloom filters."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_tables import D1, D2, D3, D4, stored, stored_metrics, txns

from paymart.plans import ingest
from paymart.schemas import METRICS_BY_STATUS, RATES, TRANSACTION_TABLE
from paymart.sinks import feed, key_index, operations, tables
from paymart.sinks.operations import store_operations


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def load(spark, path, *specs):
    """Store rows from (id, day, status, hour of sending)."""
    rows = txns(spark, *[s[:3] for s in specs])
    hours = F.element_at(F.create_map(*[F.lit(x) for s in specs for x in (s[0], s[3])]), F.col("operation_id"))
    rows = rows.withColumn("sent_dttm", F.expr("TIMESTAMP_NTZ '2022-10-01 00:00:00'") + F.make_dt_interval(hours=hours))
    return store_operations(rows, path, ingest.SENT, len(specs))


@pytest.fixture(params=["few", "many"])
def size(request, monkeypatch):
    """The same as a small load, with its ids in the scans, and as a large one."""
    if request.param == "many":
        monkeypatch.setattr(operations, "FEW", 0)


def test_a_later_copy_moves_the_operation(spark, path, size):
    assert load(spark, path, ("a", D1, "queued", 1), ("b", D1, "done", 1), ("c", D2, "done", 1)) == 3
    assert load(spark, path, ("a", D3, "done", 2), ("d", D2, "done", 2)) == 2
    assert stored(spark, path) == [("a", D3, "done"), ("b", D1, "done"), ("c", D2, "done"), ("d", D2, "done")]
    assert load(spark, path, ("a", D1, "queued", 1)) == 0  # an older copy moves nothing
    assert load(spark, path, ("a", D3, "done", 2), ("d", D2, "done", 2)) == 0
    assert load(spark, path, ("a", D1, "blocked", 5)) == 1  # and back
    assert stored(spark, path)[0] == ("a", D1, "blocked") and len(stored(spark, path)) == 4


def test_any_order_gives_the_same_table(spark, tmp_path, size):
    loads = [[("a", D1, "queued", 1), ("b", D2, "done", 9)], [("a", D2, "done", 3)], [("a", D4, "blocked", 2), ("b", D3, "done", 9)]]
    found = []
    for name, order in (("x", (0, 1, 2)), ("y", (2, 1, 0)), ("z", (1, 2, 0, 1))):
        for i in order:
            load(spark, str(tmp_path / name), *loads[i])
        found.append(stored(spark, str(tmp_path / name)))
    assert found[0] == found[1] == found[2] == [("a", D2, "done"), ("b", D3, "done")]


def test_a_day_that_loses_its_only_operation_goes(spark, tmp_path, path):
    load(spark, path, ("a", D1, "queued", 1))
    load(spark, path, ("a", D2, "done", 2))
    assert [d.name for d in (tmp_path / "table").glob("business_dt=*")] == ["business_dt=2022-10-02"]


def test_new_operations_read_no_stored_day(spark, tmp_path, path):
    load(spark, path, ("a", D1, "done", 1))
    [file] = (tmp_path / "table" / "business_dt=2022-10-01").glob("*.parquet")
    good = file.read_bytes()
    file.write_bytes(b"unreadable")  # would fail whoever opens it
    for crc in file.parent.glob(".*.crc"):
        crc.unlink()
    assert load(spark, path, ("b", D1, "done", 1), ("c", D2, "done", 1)) == 2
    file.write_bytes(good)
    assert len(stored(spark, path)) == 3


def test_a_load_that_failed_half_way_is_mended(spark, path, monkeypatch):
    load(spark, path, ("a", D1, "queued", 1), ("b", D1, "done", 1))
    moving = [("a", D2, "done", 2)]
    with monkeypatch.context() as m:
        m.setattr(operations, "overwrite_by_day", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, path, *moving)
    assert [r[1] for r in stored(spark, path)] == [D1, D2, D1]  # twice, for now
    names, days = feed.open_days(spark, path)
    assert days == {D1, D2}
    load(spark, path, *moving)
    assert stored(spark, path) == [("a", D2, "done"), ("b", D1, "done")]


def test_index_of_a_table_that_had_none(spark, tmp_path, path):
    tables.append_transactions(txns(spark, ("a", D1, "done"), ("b", D2, "done"), ("n", None, "done")), path)
    load(spark, path, ("a", D3, "done", 1))
    assert stored(spark, path) == [("a", D3, "done"), ("b", D2, "done"), ("n", None, "done")]
    assert (tmp_path / "table.keys" / f"of={key_index.BUCKETS}").is_dir()


def test_other_number_of_ranges(spark, path):
    key_index.ensure(spark, path, buckets=3)
    load(spark, path, ("a", D1, "done", 1), ("b", D1, "done", 1))
    load(spark, path, ("a", D2, "done", 2))
    assert stored(spark, path) == [("a", D2, "done"), ("b", D1, "done")]


def test_compacted_index(spark, tmp_path, path):
    key_index.ensure(spark, path, buckets=2)
    for i in range(5):
        load(spark, path, *[(f"{c}{i}", D1, "done", 1) for c in "abcdefgh"])
    before = len(list((tmp_path / "table.keys").rglob("*.parquet")))
    assert key_index.compact(spark, path) == before - 2
    assert load(spark, path, ("a0", D2, "done", 2), ("h4", D1, "done", 1), ("new", D1, "done", 1)) == 2
    assert len(stored(spark, path)) == 41 and ("a0", D2, "done") in stored(spark, path)


def test_messages_of_two_ids_for_one_operation(spark, path):
    from test_messages import envelope, payload

    body = payload(operation_id="op", transaction_dt="2022-10-02 00:00:00.000000")
    texts = [envelope("x", body=payload(operation_id="op")), envelope("y", sent="2022-10-03 00:00:00", body=body)]
    messages = spark.createDataFrame([(t.encode(),) for t in texts], "value BINARY")
    assert ingest.ingest_messages(messages, path) == [1]
    assert [(r[0], r[1]) for r in stored(spark, path)] == [("op", D2)]


def scanned_rows(df):
    """Rows that the scans of a collected frame have read from files."""

    def leaves(plan):
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        return [plan] if not children else [leaf for c in children for leaf in leaves(c)]

    plan = df._jdf.queryExecution().executedPlan()
    return sum(leaf.metrics().get("numOutputRows").get().value() for leaf in leaves(plan))


def test_few_ids_skip_row_groups(spark, path, tmp_path):
    rows = spark.range(40_000).select(F.sha1(F.col("id").cast("string")).alias("operation_id"), F.lit(D1).alias("business_dt"))
    full = txns(spark, ("x", D1, "done")).drop("operation_id", "business_dt").crossJoin(rows)
    plain = str(tmp_path / "plain")
    tables.append_by_day(full.select(*TRANSACTION_TABLE.fieldNames()).repartition(8), plain, "business_dt", ["account_number_from"])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        tables.append_transactions(full.repartition(8), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    some = [r[0] for r in rows.limit(3).collect()]
    read = lambda p: tables.read_table(spark, p, TRANSACTION_TABLE).where(F.col("operation_id").isin(some)).drop("business_dt")
    with_filter, without = read(path), read(plain)
    assert sorted(map(tuple, with_filter.collect())) == sorted(map(tuple, without.collect())) and with_filter.count() == 3
    assert scanned_rows(with_filter) < 40_000 / 2 < scanned_rows(without)


RATE = [(430, 420, day, Decimal(3)) for day in (D1, D2, D3)]


def rates_csv(tmp_path, name, *rates):
    file = tmp_path / name
    lines = [f"430,420,2022-10-0{day},{rate}" for day, rate in rates]
    file.write_text("\n".join(["currency_code,currency_code_with,date_update,currency_with_div", *lines]))
    return str(file)


def test_late_rows_reach_the_mart_and_no_other_day_is_read(spark, tmp_path, path):
    rates, mart = str(tmp_path / "rates"), str(tmp_path / "mart")
    ingest.ingest_rates(spark, rates_csv(tmp_path, "a.csv", (1, 3), (2, 3), (3, 3)), rates)
    load(spark, path, ("a", D1, "done", 1), ("b", D2, "done", 1), ("c", D3, "done", 1))
    assert ingest.update_mart(spark, path, rates, mart) == 3
    assert feed.open_days(spark, path) == feed.open_days(spark, rates) == ([], set())
    assert ingest.update_mart(spark, path, rates, mart) == 0
    load(spark, path, ("a", D2, "done", 5))
    [untouched] = (tmp_path / "table" / "business_dt=2022-10-03").glob("*.parquet")
    good = untouched.read_bytes()
    untouched.write_bytes(b"unreadable")
    for crc in untouched.parent.glob(".*.crc"):
        crc.unlink()
    assert ingest.update_mart(spark, path, rates, mart) == 1
    untouched.write_bytes(good)
    assert stored_metrics(spark, mart) == [(D2, 60), (D3, 30)]


def test_other_rates_change_their_days_alone(spark, tmp_path, path):
    rates, mart = str(tmp_path / "rates"), str(tmp_path / "mart")
    ingest.ingest_rates(spark, rates_csv(tmp_path, "a.csv", (1, 3), (2, 3)), rates)
    load(spark, path, ("a", D1, "done", 1), ("b", D2, "done", 1), ("c", D3, "done", 1))
    ingest.update_mart(spark, path, rates, mart)
    ingest.ingest_rates(spark, rates_csv(tmp_path, "b.csv", (1, 3), (2, 4), (3, 5)), rates)
    assert feed.open_days(spark, rates)[1] == {D2, D3}
    ingest.update_mart(spark, path, rates, mart)
    assert stored_metrics(spark, mart) == [(D1, 30), (D2, 40), (D3, 50)]


def test_days_stay_open_when_the_update_fails(spark, tmp_path, path):
    rates, mart = str(tmp_path / "rates"), str(tmp_path / "mart")
    tables.load_rates(spark.createDataFrame(RATE, RATES), rates)
    load(spark, path, ("a", D1, "done", 1))
    with pytest.raises(ZeroDivisionError):
        ingest.update_mart(spark, path, rates, mart, replace=lambda *a: 1 / 0)
    assert feed.open_days(spark, path)[1] == {D1}
    ingest.update_mart(spark, path, rates, mart)
    assert stored_metrics(spark, mart) == [(D1, 30)]


def test_days_that_come_during_an_update_stay_open(spark, tmp_path, path):
    rates, mart = str(tmp_path / "rates"), str(tmp_path / "mart")
    tables.load_rates(spark.createDataFrame(RATE, RATES), rates)
    load(spark, path, ("a", D1, "done", 1))

    def meanwhile(*args):
        load(spark, path, ("b", D2, "done", 1))
        return tables.replace_listed_days(*args)

    ingest.update_mart(spark, path, rates, mart, replace=meanwhile)
    assert feed.open_days(spark, path)[1] == {D2}


def test_days_with_gaps_are_replaced_and_no_others(spark, path):
    row = lambda day, n: (day, 430, n, 1, 1.0, 1, "done")
    frame = lambda *rows: spark.createDataFrame(rows, METRICS_BY_STATUS)
    tables.append_metrics(frame(row(D1, 1), row(D2, 2), row(D3, 3)), path)
    assert tables.replace_listed_days(frame(row(D1, 9), row(D2, 9)), path, [D3, D1]) == 1
    assert stored_metrics(spark, path) == [(D1, 9), (D2, 2)]
