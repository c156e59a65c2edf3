"""Every query of the catalogue against its SQL, names and values."""

import pytest

import __spark_entry__ as entry
from braid.plans import catalog

from .conftest import duck, same


@pytest.fixture(scope="module")
def con():
    return duck()


def test_all_have_sql():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
    assert len(catalog.QUERIES) >= 52


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, data, con, name):
    df = catalog.QUERIES[name](spark, data)
    if name in catalog.ORACLES:
        same(df, catalog.ORACLES[name], con)
    else:
        assert df.columns and df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
