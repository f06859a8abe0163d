"""Every registered query against its SQL, over the whole small tables."""

import pytest
from oracle import compare, connect

from paymart.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1396
    assert set(entry.oracle_sql()) <= set(entry.queries())
