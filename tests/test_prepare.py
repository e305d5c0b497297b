import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.expressions import binary_label, signed_label, with_bias
from millrace.operators import prepare


def _column(df, name):
    return [row[name] for row in df.collect()]


def test_recode_leaves_others_and_nulls(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 3.0, None)], "a double")
    assert _column(prepare.recode(df, "a", {2.0: 1.0}), "a") == [0.0, 1.0, 1.0, 3.0, None]


def test_rename_needs_the_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert prepare.rename(df, "a", "b").columns == ["b"]
    with pytest.raises(ValueError):
        prepare.rename(df, "c", "b")


def test_labels(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, None)], "a double")
    rows = df.select(binary_label("a").alias("b"), signed_label("a").alias("s")).collect()
    assert [(r.b, r.s) for r in rows] == [(0, -1.0), (1, 1.0), (0, 2.0), (0, None)]


def test_bias_is_first(spark):
    df = spark.createDataFrame([(2, 3.0)], "a int, b double")
    assert df.select(with_bias(["a", "b"])).first()[0] == [1.0, 2.0, 3.0]


def test_zscore_uses_the_population_deviation(spark):
    values = [1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = _column(prepare.fit_zscore(df, ["a"]).transform(df), "a")
    mean, deviation = statistics.fmean(values), statistics.pstdev(values)
    assert got == pytest.approx([(v - mean) / deviation for v in values])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=2, max_size=30))
def test_zscored_columns_have_mean_0_and_deviation_1(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    row = prepare.fit_zscore(df, ["a"]).transform(df).agg(F.avg("a"), F.stddev_pop("a")).first()
    if max(values) == min(values):
        assert row[0] == 0.0
    elif statistics.pstdev(values) > 1e-6:
        assert row[0] == pytest.approx(0.0, abs=1e-6) and row[1] == pytest.approx(1.0, rel=1e-6)


def test_scaling_odd_columns(spark):
    rows = [(0.1, None, float("nan"), 1.0), (0.1, None, 2.0, None), (0.1, None, 4.0, 3.0)]
    df = spark.createDataFrame(rows, "constant double, absent double, holed double, gap double")
    columns = ["constant", "absent", "holed", "gap"]
    z = prepare.fit_zscore(df, columns).transform(df)
    assert _column(z, "constant") == [0.0, 0.0, 0.0]
    assert _column(z, "absent") == [None, None, None]
    assert _column(z, "holed") == [None, -1.0, 1.0]
    assert _column(z, "gap") == [-1.0, None, 1.0]
    m = prepare.fit_minmax(df, columns).transform(df)
    assert _column(m, "constant") == [None, None, None]
    assert _column(m, "holed") == [None, 0.0, 1.0]


def test_minmax_of_train_is_not_clipped(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "a double")
    test = spark.createDataFrame([(-5.0,), (20.0,)], "a double")
    assert _column(prepare.fit_minmax(train, ["a"]).transform(test), "a") == [-0.5, 2.0]


def test_empty_table_scales_to_an_empty_table(spark):
    df = spark.createDataFrame([], "a double")
    assert prepare.fit_zscore(df, ["a"]).transform(df).count() == 0
    assert prepare.fit_minmax(df, ["a"]).transform(df).count() == 0


def test_merge_matches_names_and_keeps_copies(spark):
    a = spark.createDataFrame([(1, 2.0, 3.0)], "k int, x double, y double")
    b = spark.createDataFrame([(2.5, 2), (2.0, 1)], "x double, k int")
    merged = prepare.merge_tables([a, b, b])
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(
        [(1, 2.0, 3.0), (2, 2.5, None), (1, 2.0, None), (2, 2.5, None), (1, 2.0, None)], key=str
    )
    assert prepare.merge_tables([a, b, b], dedup=True).count() == 3


def test_assemble_missing_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises(Exception):
        prepare.assemble(df, ["a", "b"]).collect()
    assert prepare.assemble(df, ["a", "b"], missing="skip").count() == 1
    kept = prepare.assemble(df, ["a", "b"], missing="keep").collect()[1].features
    assert math.isnan(kept[0]) and kept[1] == 3.0


def test_class_rows_and_casts(spark):
    df = spark.createDataFrame([(0, "7"), (1, "8"), (None, "9")], "label int, t string")
    assert prepare.class_rows(df, "label", 1).collect()[0].t == "8"
    assert _column(prepare.to_double(df, ["t"]), "t") == [7.0, 8.0, 9.0]
