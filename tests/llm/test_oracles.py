"""The operators' queries against their SQL."""

import pytest

from braid.llm import catalog

from ..conftest import duck, same


@pytest.fixture(scope="module")
def con():
    return duck()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, data, con, name):
    same(catalog.QUERIES[name](spark, data), catalog.ORACLES[name], con)
