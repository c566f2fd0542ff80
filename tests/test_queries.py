"""Every registered query beside its SQL, over whole tables."""

import pytest
from checks import compare, duck, types

import __spark_entry__ as contract
from harness.check_sql import check_sql
from harness.queries import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(registry()) == set(check_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    frame, sql = contract.queries()[name](spark, SF_DIR), contract.oracle_sql()[name]
    spark_types, sql_types = types(frame, con, sql)
    assert spark_types == sql_types
    spark_side, sql_side = compare(frame, con, sql)
    assert spark_side == sql_side


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["repo_name", "total_events"] and result.count() == 10
