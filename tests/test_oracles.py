"""Every query against its check SQL on the small tables."""

import pytest
from compare import compare, database

from ticketlake.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_check_sql(spark, con, name):
    good, note = compare(spark, con, SF, QUERIES[name], ORACLES[name])
    assert good, note
