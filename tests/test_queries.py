"""Every registered query against its SQL on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import check, connect
from checks.oracles import all_oracles
from checks.queries import all_queries


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


@pytest.mark.parametrize("name", list(all_queries()))
def test_same_as_sql(spark, db, small, name):
    _, verdict = check(spark, db, small, name)
    assert verdict.startswith(("same", "ran")), verdict


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_only_learning_goes_without_sql():
    assert set(all_queries()) - set(all_oracles()) == {"logistic_regression"}


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
