"""Every registered query with an SQL twin gives the twin's rows."""

import os

import pytest

from tests.oracle import compare, connect
from vacancia.plans.catalog import CATALOG

FOLDER = os.environ.get("VACANCIA_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.oracle])
def test_query_equals_sql(spark, con, name):
    assert compare(CATALOG[name].run(spark, FOLDER), con, CATALOG[name].oracle) is None


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 5
    assert set(e.oracle_sql()) < set(e.queries())


def test_inventory_is_covered():
    """Every operator of the inventory shows in at least one registered query."""
    wanted = {"A": 8, "B": 8, "C": 8, "D": 18, "E": 10, "F": 20, "G": 6, "H": 9, "I": 7, "J": 6, "K": 10, "L": 14, "M": 10}
    shown = {i for q in CATALOG.values() for i in q.survey.split()}
    assert {f"{k}{i}" for k, n in wanted.items() for i in range(1, n + 1)} - shown == set()
