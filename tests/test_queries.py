"""Every registered query against its SQL (or, without one, for a stable non-empty result)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, sf_dir, name):
    ok, note = compare(spark, con, sf_dir, name)
    assert ok, note


def test_entry(spark):
    frame = entry(spark)
    assert frame.count() == 4
    assert "validation_passed" in frame.columns


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
