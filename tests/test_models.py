import pytest
from pyspark.sql import functions as F

from millrace.operators import evaluate, models


@pytest.fixture(scope="module")
def toy(spark):
    """Two features; the label is whether the first, of six values, is positive."""
    df = spark.range(1200).select("id", ((F.col("id") % 6 - 2.5) / 2.5).alias("a"), F.rand(4).alias("b"))
    return df.withColumn("label", (F.col("a") > 0).cast("int")).cache()


def _accuracy(model, df, features=("a", "b")):
    counts = evaluate.confusion_counts(models.score(model, df, list(features)))
    return evaluate.accuracy(counts).first().accuracy


def _predictions(model, df):
    return [r.prediction for r in models.score(model, df, ["a", "b"]).orderBy("id").collect()]


@pytest.mark.parametrize("fit", [models.fit_forest, models.fit_boosted, models.fit_perceptron, models.fit_large_forest])
def test_separable_rows_are_separated(toy, fit):
    settings = {"iterations": 60} if fit is models.fit_perceptron else {"trees": 10} if fit is models.fit_large_forest else {}
    model = fit(toy, ["a", "b"], **settings)
    assert _accuracy(model, toy) == 1.0
    assert models.score(model, toy, ["a", "b"]).count() == toy.count()


@pytest.mark.parametrize("fit", [models.fit_forest, models.fit_boosted, models.fit_perceptron])
def test_a_seed_repeats_the_model(toy, fit):
    assert _predictions(fit(toy, ["a", "b"]), toy) == _predictions(fit(toy, ["a", "b"]), toy)


def test_settings_reach_the_learners(toy):
    forest = models.fit_forest(toy, ["a", "b"])
    assert forest.getNumTrees == 20 and forest.getMaxDepth() == 4 and forest.getMaxBins() == 32
    assert forest.getImpurity() == "gini" and forest.numClasses == 2
    boosted = models.fit_boosted(toy, ["a", "b"])
    assert len(boosted.trees) == 20 and boosted.getStepSize() == 0.35 and boosted.getMaxBins() == 8
    assert all(t.depth <= 2 for t in boosted.trees) and boosted.getMinInstancesPerNode() == 24
    net = models.fit_perceptron(toy, ["a", "b"])
    assert list(net.getLayers()) == [2, 64, 64, 2] and net.getMaxIter() == 5


def test_wide_output_layer(toy):
    net = models.fit_perceptron(toy, ["a", "b"], layers=[2, 8, 8, 5], iterations=3)
    assert len(models.score(net, toy, ["a", "b"]).first().probability) == 5


def test_array_features(toy):
    arrays = toy.select("id", "label", F.array("a", "b").cast("array<float>").alias("v"))
    forest = models.fit_forest(arrays, "v")
    scored = models.score(forest, arrays, "v")
    assert evaluate.accuracy(evaluate.confusion_counts(scored)).first().accuracy == 1.0
    with pytest.raises(ValueError, match="inputs"):
        models.fit_perceptron(arrays, "v")


def test_missing_features_are_refused(spark):
    df = spark.createDataFrame([(1, 1.0), (0, None)], "label int, a double")
    with pytest.raises(Exception):
        models.fit_forest(df, ["a"])


def test_curves_fall(spark, toy):
    net = models.fit_perceptron(toy, ["a", "b"], iterations=8)
    losses = [r.loss for r in models.training_curve(net, spark).orderBy("iteration").collect()]
    assert len(losses) >= 2 and losses[-1] < losses[0]
    boosted = models.fit_boosted(toy, ["a", "b"], rounds=5)
    losses = [r.loss for r in models.boosting_curve(boosted, toy, ["a", "b"]).orderBy("iteration").collect()]
    assert len(losses) == 5 and losses[-1] < losses[0]
