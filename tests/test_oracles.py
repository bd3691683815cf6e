"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from tests.compare import first_difference, spark_table, sql_table
from workload import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    got = spark_table(QUERIES[name](spark, sf_dir))
    want = sql_table(duck, ORACLES[name])
    assert got == want, first_difference(got, want)


def test_entry_runs(spark):
    assert entry(spark).count() > 0
