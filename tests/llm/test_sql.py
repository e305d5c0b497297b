"""Operators that SQL can express, over the whole test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from compare import connect, differences, spark_rows, sql_rows  # noqa: E402

from millrace.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, folder, name):
    assert differences(spark_rows(QUERIES[name](spark, folder)), sql_rows(connect(folder), ORACLES[name])) == []
