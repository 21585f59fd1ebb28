"""Every registered query against its SQL statement, over whole tables."""

import os

import pytest
from conftest import DATA

import parity
from paidmedia.plans import catalog, oracle

FOLDER = f"{DATA}/sf{os.environ.get('PARITY_SF', '0.001')}"
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return parity.connect(FOLDER)


def test_every_query_has_a_statement():
    assert set(catalog.queries()) == set(SQL)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_same_rows_as_sql(spark, con, name):
    assert parity.compare(catalog.queries()[name](spark, FOLDER), con, SQL[name]) is None
