"""Every registered query with an oracle agrees with DuckDB at the smallest scale."""

from __future__ import annotations

import os

import pytest
from oracle_check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, con, name):
    assert compare(spark, con, name, queries()[name], oracle_sql()[name], SF) is None


def test_registry(spark):
    assert set(oracle_sql()) <= set(queries())
    frame = entry(spark)
    assert frame.columns[0] == "customer_unique_id" and frame.count() > 0
