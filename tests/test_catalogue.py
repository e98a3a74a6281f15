"""Every named query against its SQL twin, on the smallest tables."""

import pytest

from gaugeworks.catalogue.oracles import SQL
from gaugeworks.catalogue.queries import QUERIES
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    rows, differing, same_names, sample = compare(spark, con, name, SF)
    assert same_names and differing == 0, sample
