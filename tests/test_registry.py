"""Every registered query against its check."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from adweave.standin import catalog  # noqa: E402
from tools.compare import compare, duck  # noqa: E402

entry.oracle_sql()
CHECKS = catalog.CHECKS


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    assert name in CHECKS, "every query has a check"
    assert compare(df, con, CHECKS[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "month_start" in df.columns
