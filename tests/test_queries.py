"""Every registered query against its SQL on a second engine."""

import pytest

import __spark_entry__ as contract
from quayline.checks.oracles import ORACLES
from quayline.checks.queries import QUERIES
from oracle import differences, duck


@pytest.fixture(scope="module")
def connection(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, folder, connection, name):
    assert differences(contract.queries()[name](spark, folder), connection, contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
