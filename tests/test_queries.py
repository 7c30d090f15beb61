"""Every registered query against its SQL on another engine."""

import pytest

import __spark_entry__ as driver
from compare import database, differences
from wayfold.catalog.oracles import ORACLES
from wayfold.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return database(folder)


def test_entry_has_rows(spark):
    assert driver.entry(spark).columns == ["traj_id", "point_id", "ord", "distance_to_next"]
    assert driver.entry(spark).count() > 0


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, folder, con, name):
    assert differences(driver.queries()[name](spark, folder), con, driver.oracle_sql()[name]) is None
