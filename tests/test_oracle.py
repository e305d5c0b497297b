"""Every query against its SQL."""

import pytest
from compare import connect, differences, spark_rows, sql_rows

from millrace.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    rows = spark_rows(df)
    assert rows[1]
    assert differences(rows, sql_rows(duck, ORACLES[name])) == []
    described = duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
    assert {c: TYPES.get(t, t) for c, t, *_ in described} == dict(df.dtypes)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)
