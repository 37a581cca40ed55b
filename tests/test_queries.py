"""Every registered query against its SQL, on the smallest tables."""

import pytest
from check import differences

import __spark_entry__
from newsloom.plans.queries import ORACLES as STATEMENTS
from newsloom.plans.queries import QUERIES


def test_names_agree():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(STATEMENTS) <= set(QUERIES)
    assert set(QUERIES) - set(STATEMENTS) == {"regression_selection"}


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query(spark, small, name):
    assert differences(spark, small, QUERIES[name], STATEMENTS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STATEMENTS)))
def test_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
