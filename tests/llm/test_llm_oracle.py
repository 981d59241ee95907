"""Registered queries of the training-data package against their SQL counterparts."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect
from tests.conftest import SMALL
from tripmill.llm.oracle import ORACLE
from tripmill.llm.queries import REGISTRY


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees(spark, name):
    assert compare(spark, connect(SMALL), SMALL, name) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in REGISTRY} == {f"op{k}" for k in range(1, 14)}
    assert set(REGISTRY) | {"pipeline"} <= names
    assert set(ORACLE) <= set(contract.oracle_sql()) <= names
