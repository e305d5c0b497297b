import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import profile


def test_value_counts_drop_nulls_and_sort(spark):
    df = spark.createDataFrame([(v,) for v in (2, 1, 1, None, None, None, 3, 2, 1)], "a int")
    assert list(map(tuple, profile.value_counts(df, "a").collect())) == [(1, 3), (2, 2), (3, 1)]


def test_table_facts(spark):
    rows = [(1, None, float("nan")), (2, "x", 1.0)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    facts = {r.column: (r.type, r.non_null, r.n_rows) for r in profile.table_profile(df).collect()}
    assert facts == {"a": ("int", 2, 2), "b": ("string", 1, 2), "c": ("double", 1, 2)}
    flags = {r.column: r.has_null for r in profile.null_flags(df).collect()}
    assert flags == {"a": False, "b": True, "c": True}
    assert tuple(profile.table_shape(df).first()) == (2, 3)


def test_facts_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b double")
    assert {(r.column, r.non_null, r.n_rows) for r in profile.table_profile(df).collect()} == {("a", 0, 0), ("b", 0, 0)}
    assert not any(r.has_null for r in profile.null_flags(df).collect())
    assert profile.value_counts(df, "a").count() == 0
    assert sum(r.n for r in profile.histogram(df, ["b"]).collect()) == 0


def test_head_is_in_key_order(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in profile.head_rows(df, ["id"]).collect()] == [0, 1, 2, 3, 4]


def _bins(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    return [r.n for r in profile.histogram(df, ["a"]).orderBy("bin").collect()]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-20, 20).map(lambda i: i / 10), st.floats(-1e3, 1e3)), min_size=2, max_size=60))
def test_histogram_bins_as_numpy_does(spark, values):
    if max(values) - min(values) < 1e-6:
        return
    assert _bins(spark, values) == list(np.histogram(values, bins=10)[0])


def test_histogram_of_odd_columns(spark):
    assert _bins(spark, [3.0, 3.0, None, float("nan")]) == [0, 0, 0, 0, 0, 2, 0, 0, 0, 0]
    assert list(np.histogram([3.0, 3.0], bins=10)[0]) == [0, 0, 0, 0, 0, 2, 0, 0, 0, 0]
    assert _bins(spark, [None, None]) == [0] * 10
    with pytest.raises(ValueError, match="infinite"):
        _bins(spark, [1.0, float("inf")])


def test_histogram_counts_every_present_value(spark):
    rows = [(float(i % 17), i % 3, None if i % 5 == 0 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b int, c double")
    sums = {}
    for r in profile.histogram(df, ["a", "b", "c"]).collect():
        sums[r.column] = sums.get(r.column, 0) + r.n
    assert sums == {"a": 200, "b": 200, "c": 160}


def _holed_table(rows=300, width=12, offset=0.0):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(rows, width)) @ rng.normal(size=(width, width)) + offset
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 3] = 0.1
    x[:, 5] = np.nan
    return pd.DataFrame(x, columns=[f"c{i}" for i in range(width)])


def _matrix(df, columns):
    return {(r.col_x, r.col_y): r.r for r in profile.correlation_matrix(df, columns).collect()}


@pytest.mark.parametrize("offset", [0.0, 1e6])
@pytest.mark.parametrize("holes", [False, True])
def test_correlation_over_pairwise_complete_rows(spark, holes, offset):
    """Columns without gaps take the built-in sums, with gaps the Arrow batches."""
    table = _holed_table(offset=offset)
    table = table if holes else table.drop(columns="c5").fillna(offset)
    width = table.shape[1]
    df = spark.createDataFrame(table).replace(float("nan"), None).repartition(5)
    want = table.corr()
    got = _matrix(df, list(table.columns))
    assert len(got) == width * width
    for (a, b), r in got.items():
        if math.isnan(want.loc[a, b]):
            assert r is None, (a, b)
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-6), (a, b)


def test_correlation_is_symmetric_with_unit_diagonal(spark):
    table = _holed_table().drop(columns=["c3", "c5"])
    got = _matrix(spark.createDataFrame(table), list(table.columns))
    assert all(got[a, b] == got[b, a] for a, b in got)
    assert all(got[c, c] == pytest.approx(1.0) for c in table.columns)
