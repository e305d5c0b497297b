"""Packed summaries against plain ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.expressions import number
from millrace.operators import gather, prepare, profile
from millrace.plans import jobs


@pytest.mark.parametrize("offset", [0.0, 1e9])
@pytest.mark.parametrize("parts", [1, 9, 150])
def test_moments_far_from_zero_with_gaps(spark, offset, parts):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 4)) + offset
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 2], x[:, 3] = np.nan, 7.0
    df = spark.createDataFrame(x.tolist(), ["a", "b", "c", "d"]).repartition(parts)
    found = gather.column_moments(df, [number(c) for c in df.columns])
    assert found["n"].tolist() == (~np.isnan(x)).sum(0).tolist()
    assert np.sqrt(found["m2"] / np.maximum(found["n"], 1))[:2] == pytest.approx(np.nanstd(x[:, :2], axis=0), rel=1e-6)
    assert found["mean"][:2] == pytest.approx(np.nanmean(x[:, :2], axis=0), rel=1e-12)
    assert found["low"][2] == np.inf and found["high"][3] == 7.0
    scaled = prepare.fit_zscore(df, df.columns).transform(df).select("a", "c", "d").toPandas()
    assert scaled["a"].std(ddof=0) == pytest.approx(1.0) and scaled["c"].isna().all() and (scaled["d"] == 0).all()


def test_an_empty_table(spark):
    df = spark.range(0).select(F.col("id").cast("double").alias("a"))
    assert gather.column_moments(df, [F.col("a")])["n"].tolist() == [0]
    assert prepare.fit_zscore(df, ["a"]).ranges == {"a": (None, None)}
    scan = profile.first_scan(df, "a", ["a"])
    assert (scan.n_rows, scan.present, scan.label_counts, scan.head) == (0, [0], {}, [])


def test_a_first_reading(spark):
    rows = [(5, "x", 1.0), (3, None, float("nan")), (None, "y", 2.0), (9, "z", 2.0), (4, "x", None)]
    df = spark.createDataFrame(rows, "k int, s string, v double").repartition(3)
    scan = profile.first_scan(df, "v", ["k"], 3)
    assert scan.n_rows == 5 and scan.present == [4, 4, 3] and scan.numeric == ["k", "v"]
    assert scan.label_counts == {1.0: 1, 2.0: 2}
    assert [r[0] for r in scan.head] == [None, 3, 4] and scan.head[0] == (None, "y", 2.0)
    tables = jobs.profile_tables(df, "v", ["k"], ["k"])
    assert {r.column: r.has_null for r in tables["null_flags"].collect()} == {"k": True, "s": True, "v": True}
    assert {r.column: r.type for r in tables["profile"].collect()} == {"k": "int", "s": "string", "v": "double"}
    assert [tuple(r) for r in tables["label_counts"].collect()] == [(2.0, 2), (1.0, 1)]
    assert tables["head"].schema == df.schema and tables["head"].count() == 5
