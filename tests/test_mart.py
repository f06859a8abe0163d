"""Edge rows of the mart and of the dashboard."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paymart.functions.money import convert_amount, round_average, round_total
from paymart.operators.checks import missing_rate_report, unique_key_report
from paymart.operators.rates import dedupe_rates, join_rates
from paymart.operators.totals import account_day_status_totals, account_day_totals, currency_names
from paymart.plans.dashboard import (
    active_accounts_by_currency,
    avg_transactions_per_account,
    dashboard_source,
)
from paymart.plans.mart import (
    global_metrics,
    global_metrics_by_status,
    metrics_backfill,
    metrics_for_day,
)
from paymart.schemas import METRICS, METRICS_BY_STATUS, RATE_KEY
from paymart.sources.sqlfile import METRICS_FOR_DAY, run_sql_file

DAY = dt.date(2022, 10, 1)
NOON = dt.datetime(2022, 10, 1, 12)

TXN = (
    "operation_id STRING, account_number_from INT, account_number_to INT, currency_code INT, country STRING, "
    "status STRING, transaction_type STRING, amount BIGINT, transaction_dt TIMESTAMP_NTZ"
)
RATE = "currency_code INT, currency_code_with INT, date_update DATE, currency_with_div DECIMAL(18,6)"


def txn(account=1, to=2, code=430, status="done", amount=100, at=NOON, country="A"):
    return ("id", account, to, code, country, status, "sbp_incoming", amount, at)


def rate(value, code=430, day=DAY, quote=420):
    return (code, quote, day, Decimal(value))


@pytest.fixture
def frames(spark):
    def make(transactions, rates=()):
        return spark.createDataFrame(transactions, TXN), spark.createDataFrame(list(rates), RATE)

    return make


def totals(df):
    return [r["amount_total"] for r in df.orderBy("date_update", "currency_from").collect()]


def test_schemas(frames):
    t, c = frames([txn()], [rate("2")])
    for found, wanted in ((global_metrics(t, c), METRICS), (global_metrics_by_status(t, c), METRICS_BY_STATUS)):
        assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in wanted]


def test_test_accounts_are_left_out(frames):
    t, c = frames([txn(account=0), txn(account=-1), txn(to=0), txn(to=-1), txn()])
    assert [r["cnt_transactions"] for r in global_metrics(t, c).collect()] == [1]


def test_midnight_separates_days(frames):
    t, c = frames([txn(at=dt.datetime(2022, 10, 1, 23, 59, 59, 999000)), txn(at=dt.datetime(2022, 10, 2))])
    assert global_metrics(t, c).count() == 2
    assert [r["date_update"] for r in metrics_for_day(t, c, "2022-10-01").collect()] == [DAY]


@pytest.mark.parametrize(
    "value, positive, coalesced", [(None, 100, 100), ("0", 100, 0), ("-1", 100, -100), ("2.5", 250, 250)]
)
def test_rate_rules(frames, value, positive, coalesced):
    t, c = frames([txn()], [rate(value)] if value else [])
    assert totals(global_metrics_by_status(t, c)) == [positive]
    assert totals(global_metrics_by_status(t, c, rate_rule="coalesce_one")) == [coalesced]
    assert totals(global_metrics(t, c)) == [coalesced]


def test_rate_of_another_day_or_quote_is_not_used(frames):
    t, c = frames([txn()], [rate("5", day=dt.date(2022, 9, 30)), rate("7", quote=430)])
    assert totals(global_metrics(t, c)) == [100]


def test_doubled_rate_does_not_count_twice(frames):
    t, c = frames([txn()], [rate("2"), rate("2")])
    [row] = global_metrics_by_status(t, c).collect()
    assert (row["amount_total"], row["cnt_transactions"]) == (200, 1)


def test_conflicting_rates_fan_out_and_are_reported(frames):
    t, c = frames([txn(), txn(account=5)], [rate("2"), rate("3"), rate("3")])
    [row] = global_metrics_by_status(t, c).collect()
    assert row["amount_total"] == 2 * (200 + 300)
    assert row["cnt_transactions"] == 4
    assert row["avg_transactions_per_account"] == 1.0
    assert row["cnt_accounts_make_transactions"] == 2
    assert [r["row_count"] for r in unique_key_report(dedupe_rates(c), RATE_KEY).collect()] == [2]


def test_average_tie(frames):
    t, c = frames([txn(account=1), txn(account=1), txn(account=2), txn(account=2), txn(account=2)])
    for rounding, expected in (("half_even", 2.0), ("half_up", 3.0)):
        [row] = global_metrics(t, c, rounding=rounding).collect()
        assert row["avg_transactions_per_account"] == expected


def test_unknown_rounding(frames):
    t, c = frames([txn()])
    with pytest.raises(ValueError, match="rounding"):
        global_metrics(t, c, rounding="up")


def test_all_statuses_count_and_only_senders_are_active(frames):
    t, c = frames([txn(account=1, to=7, status="blocked"), txn(account=1, to=8), txn(account=2, to=1)])
    [row] = global_metrics(t, c).collect()
    assert (row["cnt_transactions"], row["cnt_accounts_make_transactions"]) == (3, 2)
    by_status = {r["status"]: r["cnt_accounts_make_transactions"] for r in global_metrics_by_status(t, c).collect()}
    assert by_status == {"blocked": 1, "done": 2}


def test_large_amounts_stay_exact(frames):
    huge = 9_000_000_000_000_001
    t, c = frames([txn(account=i, amount=huge) for i in range(1, 4)], [rate("1.000001")])
    assert totals(global_metrics(t, c)) == [int((3 * huge * Decimal("1.000001")).to_integral_value())]


def test_rounding_functions(spark):
    df = spark.createDataFrame([(Decimal("2.5"),), (Decimal("-2.5"),), (Decimal("3.5"),)], "v DECIMAL(10,1)")
    found = df.select(
        round_total("v"), round_total("v", "half_up"), round_average(F.col("v").cast("double"))
    ).collect()
    assert [tuple(r) for r in found] == [(2, 3, 2.0), (-2, -3, -2.0), (4, 4, 4.0)]


def test_converted_amount_type(spark):
    df = spark.createDataFrame([(10, Decimal("0.5"))], "a BIGINT, r DECIMAL(18,6)")
    found = df.select(convert_amount("a", "r").alias("x"))
    assert found.schema["x"].dataType.simpleString() == "decimal(38,6)"
    assert found.first()["x"] == Decimal("5.000000")


def test_join_rates_keeps_every_total(frames, rows):
    t, c = frames([txn(), txn(code=440)], [rate("2"), rate("9", code=999)])
    found = join_rates(account_day_status_totals(t), c)
    assert rows(found, "currency_code", "currency_with_div") == [(430, Decimal("2.000000")), (440, None)]


def test_backfill_is_the_union_of_its_days(frames, rows):
    days = [dt.datetime(2022, 10, d, h) for d in (1, 2, 3, 4) for h in (0, 23)]
    t, c = frames(
        [txn(account=i + 1, at=at, amount=10 * i) for i, at in enumerate(days)],
        [rate("2", day=dt.date(2022, 10, d)) for d in (1, 2, 3)],
    )
    one_by_one = [rows(metrics_for_day(t, c, f"2022-10-0{d}")) for d in (2, 3)]
    assert rows(metrics_backfill(t, c, "2022-10-02", "2022-10-03")) == sum(one_by_one, [])


def test_sql_file_gives_the_same_day(spark, frames, rows):
    t, c = frames(
        [txn(account=a, status=s, code=k) for a in (1, 2) for s in ("done", "queued") for k in (430, 440)],
        [rate("2"), rate("3"), rate("3"), rate("0", code=440)],
    )
    found = run_sql_file(spark, METRICS_FOR_DAY, {"business_dt": "2022-10-01", "quote": 420}, transactions=t, rates=c)
    assert rows(found) == rows(metrics_for_day(t, c, "2022-10-01"))


def test_dashboard_label_and_two_countries(frames, rows):
    t, c = frames([txn(country="A"), txn(country="B"), txn(code=440, country="C")])
    names = currency_names(t)
    found = dashboard_source(global_metrics(t, c), names.where("currency_code = 430"))
    assert rows(found, "currency_name") == [("A | cur",), ("B | cur",)]


def test_activity_is_not_rounded(frames, rows):
    t, _ = frames([txn(account=1), txn(account=1, status="queued"), txn(account=2), txn(account=0)])
    assert rows(active_accounts_by_currency(t), "active_accounts") == [(2,)]
    assert rows(avg_transactions_per_account(t), "avg_transactions") == [(1.5,)]


def test_missing_rates(frames, rows):
    t, c = frames(
        [txn(), txn(code=440), txn(code=450), txn(code=420), txn(code=460, account=0)],
        [rate("2"), rate("0", code=440)],
    )
    assert rows(missing_rate_report(t, c), "currency_code", "cnt_transactions") == [(440, 1), (450, 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(
            st.integers(-1, 3), st.integers(0, 2), st.sampled_from([420, 430]), st.sampled_from(["done", "queued"]),
            st.integers(0, 10**9),
        ),
        min_size=1,
        max_size=25,
    ),
    rates=st.lists(st.sampled_from(["-1", "0", "0.5", "2.25"]), max_size=3),
)
def test_mart_against_a_plain_loop(frames, data, rates):
    """Joining the rates to the cells equals joining them to every account."""
    t, c = frames(
        [txn(account=a, to=b, code=k, status=s, amount=m) for a, b, k, s, m in data], [rate(r) for r in rates]
    )
    per_account = {}
    for a, b, k, s, m in data:
        if a > 0 and b > 0:
            total, n = per_account.get((k, s, a), (0, 0))
            per_account[k, s, a] = (total + m, n + 1)
    expected = {}
    for (k, s, a), (total, n) in per_account.items():
        matched = [Decimal(r) for r in dict.fromkeys(rates)] if k == 430 else []
        for r in matched or [None]:
            cell = expected.setdefault((k, s), [Decimal(0), [], set()])
            cell[0] += total * (r if r and r > 0 else 1)
            cell[1].append(n)
            cell[2].add(a)
    found = {
        (r["currency_from"], r["status"]): (
            r["amount_total"],
            r["cnt_transactions"],
            r["avg_transactions_per_account"],
            r["cnt_accounts_make_transactions"],
        )
        for r in global_metrics_by_status(t, c).collect()
    }
    assert found == {
        key: (int(total.to_integral_value()), sum(counts), float(round(sum(counts) / len(counts))), len(accounts))
        for key, (total, counts, accounts) in expected.items()
    }


HUGE = 5 * 10**18


def huge(spark, *senders):
    rows = [(str(i), s, 2, 430, "A", "done", "t", HUGE, dt.datetime(2022, 10, 1, 9)) for i, s in enumerate(senders)]
    return spark.createDataFrame(rows, "operation_id STRING, account_number_from INT, account_number_to INT, currency_code INT, country STRING, status STRING, transaction_type STRING, amount LONG, transaction_dt TIMESTAMP_NTZ")


@pytest.mark.parametrize("senders", [(1, 1), (1, 2), (1, 1, 2, 3)])
def test_any_sum_of_bigints(spark, senders):
    rates = spark.sql("SELECT 430 AS currency_code, 420 AS currency_code_with, DATE '2022-10-01' AS date_update, CAST(3 AS DECIMAL(18,6)) AS currency_with_div")
    for metrics in (global_metrics, global_metrics_by_status):
        [row] = metrics(huge(spark, *senders), rates, wide=True).collect()
        assert row["amount_total"] == 3 * HUGE * len(senders) and row["cnt_accounts_make_transactions"] == len(set(senders))
        with pytest.raises(Exception, match="beyond BIGINT.*2022-10-01, 430"):
            metrics(huge(spark, *senders), rates).collect()
    totals = account_day_totals(huge(spark, *senders), wide=True).collect()
    assert sum(r["amount_total"] for r in totals) == HUGE * len(senders)
