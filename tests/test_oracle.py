"""Every registered query beside its SQL on the smallest tables."""

import pytest

from check_oracle import difference, open_oracle
from rowmill.registry import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(name, spark, oracle):
    assert difference(all_queries()[name], spark, oracle, SF_DIR) is None
