"""Every query against its SQL statement, over whole tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from sluice.queries import QUERIES as OWN

FOLDER = "/root/testdata/sf0.001"
# The library's own queries; those of the optional part have their own tests.
QUERIES = {name: query for name, query in entry.queries().items() if name in OWN}
STATEMENTS = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS) == set(OWN)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_statement(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, STATEMENTS[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_data_reaches_every_branch(spark):
    """Rows that the comparison above would not miss if they were gone."""
    chained = QUERIES["cohort_variance_report"](spark, FOLDER).collect()
    assert any(r["metric_value_last_month_avg"] is not None for r in chained)
    default = QUERIES["step_lag_samples_default"](spark, FOLDER).collect()
    assert any(v is not None for r in default for v in r[1:])
