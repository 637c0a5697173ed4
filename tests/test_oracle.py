"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from basinflow.plans.catalog import load
from tools.check import compare, connect

QUERIES, SQL = load()


@pytest.fixture(scope="module")
def duck(sf):
    con = connect(sf)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    got = QUERIES[name](spark, sf).toPandas()
    assert name in SQL
    assert compare(got, duck.execute(SQL[name]).df()) is None
    assert len(got) > 0


def test_entry(spark):
    assert entry(spark).columns == ["i_index", "j_index", "IDmask", "weight", "regridweight"]
