"""Every registered query against its SQL counterpart, at the smallest scale."""

import os

import pytest

import __spark_entry__ as registered
from compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query(spark, con, name):
    message, *_ = compare(spark, con, name, registered.queries()[name], registered.oracle_sql().get(name), SF)
    assert message is None, message


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).limit(1).count() == 1
