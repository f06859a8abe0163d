"""All reports out of one read of a load, against the single reports."""

import pytest
from pyspark.sql import functions as F

from paymart import fixtures
from paymart.operators import checks
from paymart.plans import ingest
from paymart.schemas import STATUSES, TRANSACTION_TYPES, TXN_COLUMNS


@pytest.fixture(scope="module")
def rows_of(spark, sf_dir):
    """Transactions with missing and odd values and repeated keys."""
    good = fixtures.transactions(spark, sf_dir)
    number = F.col("operation_id").cast("bigint")
    return (
        good.withColumn("country", F.when(number % 5 != 0, F.col("country")))
        .withColumn("status", F.when(number % 4 == 0, F.lit(None)).when(number % 7 == 0, F.lit("?")).otherwise(F.col("status")))
        .withColumn("amount", F.when(number % 6 != 0, F.col("amount") * 100))
        .withColumn("operation_id", F.when(number % 9 == 0, F.lit("twice")).when(number % 11 != 0, F.col("operation_id")))
    )


def test_reports_equal_the_single_ones(spark, sf_dir, rows_of, rows, tmp_path):
    ingest.transaction_facts(rows_of).write.parquet(str(tmp_path / "facts"))
    facts = spark.read.schema(checks.FACTS).parquet(str(tmp_path / "facts"))
    domains = {"status": STATUSES, "transaction_type": TRANSACTION_TYPES}
    rates = fixtures.currencies(spark, sf_dir)
    key = rows_of.select("operation_id").schema
    for found, want in (
        (checks.null_report_of(facts, TXN_COLUMNS), checks.not_null_report(rows_of, TXN_COLUMNS)),
        (checks.domain_report_of(facts), checks.domain_report(rows_of, domains)),
        (checks.int_range_report_of(facts, ["amount"]), checks.int_range_report(rows_of, ["amount"])),
        (checks.unique_key_report_of(facts, key), checks.unique_key_report(rows_of, ["operation_id"])),
        (checks.missing_rate_report_of(facts, rates), checks.missing_rate_report(rows_of, rates)),
    ):
        assert rows(found, *want.columns) == rows(want) and rows(want)


def test_one_scan_and_one_exchange(spark, sf_dir):
    rows = fixtures.event_transactions(spark, sf_dir)
    plan = ingest.transaction_facts(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Python" not in plan


def test_facts_of_an_empty_load(spark, sf_dir):
    facts = ingest.transaction_facts(fixtures.transactions(spark, sf_dir).where("false"))
    assert facts.count() == 0
    assert {r["null_count"] for r in checks.null_report_of(facts, TXN_COLUMNS).collect()} == {0}


def test_a_load_leaves_its_facts(spark, sf_dir, tmp_path):
    table, facts = str(tmp_path / "t"), str(tmp_path / "facts")
    ingest.ingest_messages(fixtures.messages(spark, sf_dir), table, facts_path=facts)
    stored = spark.read.schema(checks.FACTS).parquet(facts)
    assert checks.unique_key_report_of(stored, fixtures.transactions(spark, sf_dir).select("operation_id").schema).count() == 0
    assert stored.where("kind = 'rate'").count() > 0
