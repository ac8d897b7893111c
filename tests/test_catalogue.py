"""Every catalogue query against its SQL on the smallest generated tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from tests.check_catalogue import connect, difference

SF_DIR = os.environ.get("CATALOGUE_SF_DIR", "/root/testdata/sf0.001")

# Three whole loads each; tests/test_load.py and tests/check_catalogue.py cover them.
LOADS = {"q_incremental_load", "q_stream_increment", "q_incremental_policy_changes"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated tables not found")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    own = {name for name in driver.queries() if name.startswith("q_")}
    assert own - set(driver.oracle_sql()) == set()
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted({name for name in driver.oracle_sql() if name.startswith("q_")} - LOADS))
def test_query_agrees_with_sql(spark, duck, name):
    assert difference(duck, driver.queries()[name](spark, SF_DIR), driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).columns == ["Customer_ID", "Customer_Name", "Region", "Total_Policy_Amt"]
