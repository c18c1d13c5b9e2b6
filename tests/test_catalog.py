"""Every catalogued query against its SQL."""

import os
import re

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from paddock.plans import catalog
from paddock.plans.views import Tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not there")

@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "championship_pos" in df.columns


def test_tables_are_opened_by_name_only(spark):
    with pytest.raises(AttributeError):
        Tables(spark, FOLDER).no_such_table


def lineitem_scans(df):
    """The different scans of lineitem in a plan: each is shuffled anew."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {re.sub(r"#\d+L?", "", line.split("FileScan")[1]) for line in plan.split("\n") if "FileScan" in line and "l_orderkey" in line}


@pytest.mark.parametrize("name, scans", [("hypothesis_log", 2), ("hypothesis_summary", 2), ("master_flat", 2)])
def test_tests_and_tables_share_their_scans(spark, name, scans):
    assert len(lineitem_scans(contract.queries()[name](spark, FOLDER))) == scans


def test_circuit_map_cuts_its_join(spark):
    plan = contract.queries()["circuit_map"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
