"""Every registered query beside its SQL, on the smallest given tables."""

import pytest

import __spark_entry__ as contract
from benchmarks.check_oracle import compare, connect

from orefold.workload.oracle import ORACLE
from orefold.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    got = contract.entry(spark)
    assert got.columns[:3] == ["band", "d_type", "total_lines"] and got.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name) == ""
