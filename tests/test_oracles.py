"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as project
from oracles.compare import difference, open_tables

QUERIES, ORACLES = project.queries(), project.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return open_tables(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, sf_dir, name):
    assert difference(spark, connection, QUERIES[name], ORACLES[name], sf_dir) == ""


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert project.entry(spark).columns == [
        "country_code", "city_name", "vehicle_class", "average_velocity", "city_rank_by_detections",
    ]
