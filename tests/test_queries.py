"""Every registered query beside its SQL counterpart, on whole tables."""

import pytest

import __spark_entry__ as entry
import oracle
from tablewright import plans

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(plans.oracle_sql()) == set(plans.queries())
    assert set(plans.queries()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, con, name):
    problem, _ = oracle.difference(plans.queries()[name](spark, FOLDER), con, plans.oracle_sql()[name])
    assert not problem, problem
