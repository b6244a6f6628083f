"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import re

import pytest

import oracle
import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_of_the_reference_has_its_sql():
    optional = re.compile(r"op\d+_|pipeline$")
    own = {name for name in contract.queries() if not optional.match(name)}
    assert own <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert oracle.compare(df, con, contract.oracle_sql()[name]) > 0


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
