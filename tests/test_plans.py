"""The plans that matter at scale: what is pushed down, shuffled, broadcast."""

import contextlib
import io
import re

import pytest

from paymart import fixtures, functions
from paymart.plans import dashboard, mart
from paymart.queries import QUERIES
from paymart.schemas import TRANSACTION_TABLE
from paymart.sinks import tables

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans_of(df):
    """The pushed filters of each scan, in full."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return [line for line in out.getvalue().splitlines() if line.startswith(("PushedFilters", "PartitionFilters"))]


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    transactions, rates = str(root / "transactions"), str(root / "rates")
    tables.append_transactions(
        functions.conform_transaction(fixtures.event_transactions(spark, sf_dir)), transactions
    )
    tables.load_rates(fixtures.currencies(spark, sf_dir), rates)
    return tables.read_table(spark, transactions, TRANSACTION_TABLE), tables.read_rates(spark, rates)


@pytest.fixture
def no_broadcast(spark):
    """What Spark plans when no side is known to be small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_day_of_a_stored_table_prunes_partitions(stored):
    transactions, rates = stored
    scans = "\n".join(scans_of(mart.metrics_for_day(transactions, rates, "2024-01-05")))
    assert re.search(r"PartitionFilters: \[[^\]]*business_dt#\d+ = 2024-01-05", scans)
    assert "EqualTo(date_update,2024-01-05)" in scans
    assert "EqualTo(currency_code_with,420)" in scans
    assert "GreaterThan(account_number_from,0)" in scans


def test_only_needed_columns_are_read(stored):
    transactions, rates = stored
    plan = plan_of(mart.global_metrics_by_status(transactions, rates))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    read = {tuple(f.split(":")[0] for f in s.split(",") if ":" in f) for s in schemas}
    assert ("account_number_from", "account_number_to", "currency_code", "status", "amount") in read


def test_day_of_raw_times_becomes_a_range_in_the_scan(spark, sf_dir):
    transactions = fixtures.event_transactions(spark, sf_dir)
    rates = fixtures.currencies(spark, sf_dir)
    for df in (
        mart.metrics_for_day(transactions, rates, "2024-01-05"),
        mart.metrics_backfill(transactions, rates, "2024-01-05", "2024-01-05"),
    ):
        scans = scans_of(df)
        assert any(
            "GreaterThanOrEqual(ts,2024-01-05T00:00), LessThan(ts,2024-01-06T00:00)" in scan for scan in scans
        )


def test_mart_shuffles_twice_and_joins_cells(stored, no_broadcast):
    transactions, rates = stored
    plan = plan_of(mart.global_metrics_by_status(transactions, rates))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "count(distinct" not in plan
    accounts = [line for line in plan.splitlines() if "Exchange" in line and "account_number_from" in line]
    assert len(accounts) == 1
    below = plan[plan.index(accounts[0]) :]
    assert re.search(r"partial_sum\((cast\()?amount", below)


def test_rate_join_above_the_cells(stored):
    transactions, rates = stored
    plan = plan_of(mart.global_metrics_by_status(transactions, rates))
    assert plan.index("Join") < plan.index("account_number_from")


def test_activity_needs_no_distinct_aggregate(stored):
    transactions, _ = stored
    for df in (
        dashboard.active_accounts_by_currency(transactions),
        dashboard.avg_transactions_per_account(transactions),
    ):
        plan = plan_of(df)
        assert "distinct" not in plan and plan.count("Exchange") == 2


class Plans:
    """The plans of all jobs that run meanwhile, those of writers and micro-batches included."""

    def __init__(self, spark):
        self.store = spark._jsparkSession.sharedState().statusStore()
        self.before = self.store.executionsCount()

    def seen(self):
        executions = self.store.executionsList(self.before, 1000)
        return [executions.apply(i).physicalPlanDescription() for i in range(executions.size())]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_queries(spark, sf_dir, no_broadcast, name):
    ran = Plans(spark)
    plans = [plan_of(QUERIES[name](spark, sf_dir))]
    for plan in [*plans, *ran.seen()]:
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "Python", "Pandas", "Arrow"):
            assert operator not in plan, (name, operator)


def test_one_hot_account_and_day(spark):
    """A third of all rows on one account and day: equal to counting by hand."""
    n = 60_000
    rows = spark.range(n).selectExpr(
        "CAST(id AS STRING) AS operation_id",
        "CAST(IF(id % 3 = 0, 7, id % 1000 + 1) AS INT) AS account_number_from",
        "2 AS account_number_to",
        "430 AS currency_code",
        "'A' AS country",
        "'done' AS status",
        "'sbp_incoming' AS transaction_type",
        "id AS amount",
        "TIMESTAMP_NTZ '2022-10-01 10:00:00' AS transaction_dt",
    )
    rates = spark.sql(
        "SELECT 430 AS currency_code, 420 AS currency_code_with, DATE '2022-10-01' AS date_update, "
        "CAST(2 AS DECIMAL(18,6)) AS currency_with_div"
    )
    [row] = mart.global_metrics_by_status(rows, rates).collect()
    assert row["amount_total"] == n * (n - 1)
    assert row["cnt_transactions"] == n
    assert row["cnt_accounts_make_transactions"] == len({7 if i % 3 == 0 else i % 1000 + 1 for i in range(n)})
