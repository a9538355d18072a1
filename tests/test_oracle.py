"""Every registered query against its SQL."""

import pytest
from comparison import differences, duckdb_connection

from shiftledger import registry

registry.load()


@pytest.fixture(scope="module")
def connection(data_folder):
    return duckdb_connection(data_folder)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows(spark, data_folder, connection, name):
    found = differences(spark, registry.QUERIES[name], registry.ORACLES[name], data_folder, connection)
    assert not found, found


def test_every_query_has_sql():
    assert registry.QUERIES.keys() == registry.ORACLES.keys()
