"""Every registered text query that SQL can express against its SQL twin."""

from __future__ import annotations

import pytest

from lotwise.llm.registry import ORACLES, QUERIES
from tests.compare import first_difference, spark_table, sql_table


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    got = spark_table(QUERIES[name](spark, sf_dir))
    want = sql_table(duck, ORACLES[name])
    assert got == want, first_difference(got, want)
