"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from leaguelake.catalog import QUERIES
from leaguelake.oracle import ORACLE
from oracle_check import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert differences(frame, con, contract.oracle_sql()[name]) == []


# a trained forest's own values: tests/test_model.py holds them against SQL over the forest's node table
FOREST = {"rf_predictions", "rf_importance", "rf_nodes"}


def test_every_query_has_sql():
    assert set(QUERIES) - FOREST == set(ORACLE)
