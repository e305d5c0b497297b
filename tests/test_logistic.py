import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.expressions import logistic_loss, logistic_slope
from millrace.operators import logistic


def _data(rows=400, width=3, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, width))
    y = np.where(x @ np.arange(1, width + 1) + 0.5 + rng.normal(size=rows) > 0, 1, 0)
    training = rng.random(rows) < 0.8
    return x, y, training


def _frame(spark, x, y, training):
    names = [f"f{j}" for j in range(x.shape[1])]
    rows = [(*map(float, r), int(l), bool(t)) for r, l, t in zip(x, y, training)]
    schema = ", ".join(f"{n} double" for n in names) + ", label int, tr boolean"
    return spark.createDataFrame(rows, schema).repartition(4), names


def _descend(x, y, training, alpha, lam, updates):
    """The formulas row by row, as plain numpy."""
    signed = np.where(y == 0, -1, y)
    bias = np.column_stack([np.ones(len(x)), x])
    beta, history = np.zeros(x.shape[1] + 1), []
    for _ in range(updates):
        slope = -signed / (1 + np.exp(signed * (bias @ beta)))
        gradient = (slope[training, None] * bias[training]).sum(axis=0) + 2 * lam * beta
        beta = beta - alpha * gradient
        z = bias @ beta
        loss = np.log(1 + np.exp(-signed * z))[training].sum() + lam * beta @ beta
        rates = []
        for part in (training, ~training):
            tp, fp = (np.sum((z > 0) & (signed == s) & part) + 1 for s in (1, -1))
            tn, fn = (np.sum((z < 0) & (signed == s) & part) + 1 for s in (-1, 1))
            rates += [(tp + tn) / (tp + fp + tn + fn), tp / (tp + fp), tp / (tp + fn)]
        history.append((loss, math.sqrt(gradient @ gradient), *rates))
    return beta, history


@pytest.mark.parametrize("wide", [False, True])
def test_training_follows_the_formulas(spark, wide):
    x, y, training = _data()
    df, names = _frame(spark, x, y, training)
    beta, history = _descend(x, y, training, 0.005, 0.3, 6)
    fit = logistic.train(df, names, "label", F.col("tr"), lam=0.3, eps=1e-9, max_iter=7, alpha=0.005, wide=wide)
    assert fit.beta == pytest.approx(list(beta), rel=1e-9)
    assert fit.iterations == 7 and not fit.converged
    for k, (got, want) in enumerate(zip(fit.history, history, strict=True), start=1):
        assert got[0] == k and got[3] == 0.005
        assert (got[1], got[2], *got[4:]) == pytest.approx(want, rel=1e-9)
    frame = fit.history_frame(spark)
    assert frame.count() == 6 and frame.columns[:4] == ["iteration", "loss", "grad_norm", "alpha"]
    terms = [r.term for r in fit.coefficients_frame(spark).orderBy("position").collect()]
    assert terms == ["intercept", *names]


def test_gradient_is_the_slope_of_the_loss(spark):
    x, y, training = _data(60)
    df, names = _frame(spark, x, y, training)
    rows = logistic.prepare_rows(df, names, "label", F.col("tr"))
    beta, step = np.array([0.2, -0.1, 0.4, 0.3]), 1e-5
    gradient = logistic.total_gradient(rows, beta, 0.7)
    for j in range(4):
        shift = np.eye(4)[j] * step
        slope = (logistic.total_loss(rows, beta + shift, 0.7) - logistic.total_loss(rows, beta - shift, 0.7)) / (2 * step)
        assert gradient[j] == pytest.approx(slope, rel=1e-5, abs=1e-6)


def test_stop_rules(spark):
    x, y, training = _data(50)
    df, names = _frame(spark, x, y, training)
    for limit in (0, 1):
        fit = logistic.train(df, names, "label", max_iter=limit)
        assert fit.history == [] and fit.beta == [0.0] * 4 and fit.iterations == 1 and not fit.converged
    assert logistic.train(df, names, "label", eps=0.0, max_iter=9).history == []
    quick = logistic.train(df, names, "label", eps=1e6, max_iter=9, alpha=1e-3)
    assert len(quick.history) == 1 and quick.converged  # one update, then the norm is small enough
    assert logistic.Fit([], [], 0.1).history_frame(spark).count() == 0


def test_loss_falls_for_small_steps(spark):
    x, y, training = _data(300)
    df, names = _frame(spark, x, y, training)
    losses = [h[1] for h in logistic.train(df, names, "label", lam=0.1, eps=1e-9, max_iter=12, alpha=1 / 300).history]
    assert losses == sorted(losses, reverse=True)


def test_continued_training_equals_one_run(spark):
    x, y, training = _data(80)
    df, names = _frame(spark, x, y, training)
    settings = dict(lam=0.1, eps=1e-9, alpha=0.01)
    first = logistic.train(df, names, "label", max_iter=4, **settings)
    second = logistic.train(df, names, "label", max_iter=3, beta=first.beta, **settings)
    assert second.beta == pytest.approx(logistic.train(df, names, "label", max_iter=6, **settings).beta)


def test_signed_and_binary_labels_agree(spark):
    x, y, training = _data(80)
    df, names = _frame(spark, x, y, training)
    signed = df.withColumn("label", F.when(F.col("label") == 0, -1).otherwise(1))
    a, b = (logistic.train(d, names, "label", max_iter=4, alpha=0.01).beta for d in (df, signed))
    assert a == pytest.approx(b)


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("hole", ["feature", "label", "nan"])
def test_missing_values_are_an_error(spark, wide, hole):
    rows = [(1.0, 1), (None if hole == "feature" else float("nan") if hole == "nan" else 2.0, None if hole == "label" else 0)]
    df = spark.createDataFrame(rows, "f double, label int")
    with pytest.raises(ValueError, match="1 rows have a missing"):
        logistic.train(df, ["f"], "label", max_iter=3, wide=wide)


def test_array_features(spark):
    x, y, training = _data(120)
    df, names = _frame(spark, x, y, training)
    arrays = df.select("label", "tr", F.array(*names).cast("array<float>").alias("v"))
    columns = df.select("label", "tr", *[F.col(n).cast("float").alias(n) for n in names])
    a = logistic.train(arrays, "v", "label", F.col("tr"), max_iter=4, alpha=0.01)
    b = logistic.train(columns, names, "label", F.col("tr"), max_iter=4, alpha=0.01)
    assert a.beta == pytest.approx(b.beta) and a.features == ["v[0]", "v[1]", "v[2]"]
    ragged = arrays.withColumn("v", F.when(F.col("label") == 1, F.col("v")).otherwise(F.array(F.lit(1.0).cast("float"))))
    with pytest.raises(ValueError):
        logistic.train(ragged, "v", "label", max_iter=3)


def _hinge():
    rest = lambda y, z: F.greatest(F.lit(1.0) - y * z, F.lit(0.0))
    return logistic.Loss(lambda y, z: F.pow(rest(y, z), 2), lambda y, z: F.lit(-2.0) * y * rest(y, z))


@pytest.mark.parametrize("width", [logistic.WIDE, logistic.WIDE + 1, 500])
def test_a_loss_means_the_same_at_any_width(spark, width):
    df = spark.range(40).select((F.col("id") % 2).alias("label"), (F.col("id") % 5 > 0).alias("tr"),
                                *[F.sin(F.col("id") * (j + 1)).alias(f"f{j}") for j in range(width)])
    names = [f"f{j}" for j in range(width)]
    assert logistic.prepare_rows(df, names, "label").wide == (width > logistic.WIDE)
    beta = [0.1, *np.linspace(-0.2, 0.3, width)]
    holed = df.withColumns({"f0": F.expr("CASE f1 > 0.9 WHEN true THEN double('NaN') ELSE f0 END"),
                            "f2": F.expr("CASE WHEN f1 > -0.9 THEN f2 END"), "label": F.expr("CASE WHEN f1 < 0.8 THEN label END")})
    for table in (df, holed):
        passes = [logistic.run_pass(logistic.prepare_rows(table, names, "label", F.col("tr"), _hinge(), wide), beta) for wide in (False, True)]
        assert passes[0].unscored == passes[1].unscored and (passes[0].unscored > 0) == (table is holed)
        assert passes[0].loss == pytest.approx(passes[1].loss) and passes[0].gradient == pytest.approx(passes[1].gradient)
        assert (passes[0].train, passes[0].test) == (passes[1].train, passes[1].test)


def test_the_longest_array_gives_the_width(spark):
    df = spark.createDataFrame([([1.0], 1), ([1.0, 2.0], 0), (None, 1)], "v array<double>, label int").coalesce(1)
    rows = logistic.prepare_rows(df, "v", "label")
    assert rows.width == 2 and logistic.run_pass(rows, [0.0] * 3).unscored == 2
    assert logistic.prepare_rows(df.limit(0), "v", "label").width == 0


def test_extreme_margins_do_not_overflow(spark):
    df = spark.createDataFrame([(1.0, 900.0), (1.0, -900.0), (-1.0, 900.0)], "y double, z double")
    rows = df.select(logistic_loss(F.col("y"), F.col("z")).alias("l"), logistic_slope(F.col("y"), F.col("z")).alias("s")).collect()
    assert [r.l for r in rows] == [0.0, 900.0, 900.0]
    assert [r.s for r in rows] == pytest.approx([0.0, -1.0, 1.0])


def test_confusion_leaves_out_scores_of_zero(spark):
    rows = [(1, 2.0), (0, 1.0), (0, -1.0), (1, -3.0), (1, 0.0), (1, 5.0)]
    df = spark.createDataFrame(rows, "label int, score double")
    counts = logistic.confusion(df, "label")
    assert counts.first().asDict() == {"p": 5.0, "n": 4.0, "tp": 3.0, "fp": 2.0, "tn": 2.0, "fn": 2.0}
    row = logistic.smoothed_metrics(counts).first()
    assert tuple(row) == pytest.approx((5 / 9, 3 / 5, 3 / 5))
    assert tuple(logistic.smoothed_metrics(logistic.confusion(df.limit(0), "label")).first()) == (0.5, 0.5, 0.5)


def test_score_and_sign(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 0.0), (-3.0, 1.0)], "a double, b double")
    rows = logistic.score(df, ["a", "b"], [-1.0, 1.0, 0.5]).collect()
    assert [(r.score, r.prediction) for r in rows] == [(1.0, 1), (-1.0, -1), (-3.5, -1)]
    with pytest.raises(ValueError):
        logistic.score(df, ["a"], [1.0])


@pytest.mark.parametrize("wide", [False, True])
def test_diverged_weights_are_an_error(spark, wide):
    df = spark.createDataFrame([(1e200, 1), (-1e200, 0)], "f double, label int")
    with pytest.raises(ValueError, match="diverged at update"):
        logistic.train(df, ["f"], "label", lam=1.0, max_iter=20, alpha=1e200, wide=wide)
