import os

import pytest


@pytest.fixture(autouse=True, scope="session")
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", 4)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with a column that clashes."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None, 1) for r in rows]
        return spark.createDataFrame(full, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, size INT")

    return make


@pytest.fixture(scope="session")
def small_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
