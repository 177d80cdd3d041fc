"""Every registered query equals its SQL on the test tables."""

import pytest

from registry.catalog import ORACLES, QUERIES
from registry.compare import compare


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, oracle, name):
    status, _ = compare(QUERIES[name](spark, sf_dir), oracle, ORACLES[name])
    assert status == "exact", f"{name}: {status}"
