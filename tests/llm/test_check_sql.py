"""The registered queries that have check SQL, on the small tables."""

import pytest
from compare import compare, database

from ticketlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_check_sql(spark, name):
    good, note = compare(spark, database(SF), SF, QUERIES[name], ORACLES[name])
    assert good, note
