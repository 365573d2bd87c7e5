"""Every query of the library against its SQL on the same tables."""

import pytest

from gleanmill.plans import catalog
from tests.conftest import DATA, same_rows


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, duck, name):
    same_rows(catalog.QUERIES[name](spark, DATA), duck.sql(catalog.ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0
