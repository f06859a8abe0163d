import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from paymart.session import get_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "paymart-tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": 8,
            "spark.ui.enabled": "false",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows():
    """Sorted plain tuples of a frame, NULLs first."""

    def read(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t]
        )

    return read
