"""Every check query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
import workloads.registry as registry
from tests.check import compare
from tests.conftest import SF

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
