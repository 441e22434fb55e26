"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as contract
from bindings import all_queries

SF = "/root/testdata/sf0.001"
QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    assert oracle.compare(QUERIES[name](spark, SF), duck, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(all_queries()) <= set(ORACLE)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
