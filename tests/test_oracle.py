"""Every registered query against its SQL counterpart on the small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect
from tests.conftest import SMALL
from tripmill.workload.oracle import ORACLE
from tripmill.workload.queries import REGISTRY



@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_agrees(spark, con, name):
    assert compare(spark, con, SMALL, name) is None


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["grain", "pickup_month", "pickup_zone", "total_trips", "rnk"]
    assert result.count() > 0
