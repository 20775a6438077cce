"""Every registered query gives what its SQL gives, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from checks.compare import database, difference
from checks.registry import all_queries

# Thresholds that no group of the smallest tables reaches.
MAY_BE_EMPTY = {"no rows"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, connection, sf_dir, name):
    problem = difference(spark, connection, sf_dir, name)
    assert problem is None or problem in MAY_BE_EMPTY


def test_entry_points_agree():
    own = all_queries().keys()
    assert own <= entry_points.queries().keys()
    assert own <= entry_points.oracle_sql().keys() <= entry_points.queries().keys()


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 25
