"""Every registered query with SQL must equal DuckDB's answer on the same tables."""

import pytest

from riskloom.catalog import ENTRIES
from tests.compare import differences, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.oracle])
def test_matches_sql(spark, con, sf_dir, name):
    assert differences(spark, con, sf_dir, name) == []


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 5
