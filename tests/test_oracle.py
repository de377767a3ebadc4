"""Every registered query against its SQL."""

import __spark_entry__ as entry
import compare
import pytest
from penstock.plans import registry


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.duck(sf_dir)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, sf_dir, duck, name):
    assert compare.differences(entry.queries()[name](spark, sf_dir), duck, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
