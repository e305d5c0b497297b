import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace.operators import evaluate


def _scored(spark, classes=3, rows=500):
    p = F.array(*[F.abs(F.sin(F.col("id") * (i + 1))) + 0.01 for i in range(classes)])
    total = F.aggregate(p, F.lit(0.0), lambda a, b: a + b)
    df = spark.range(rows).select("id", (F.col("id") % classes).cast("double").alias("label"),
                                  F.transform(p, lambda v: v / total).alias("p"))
    place = F.array_position("p", F.array_max("p")) - 1
    return df.withColumns({"prediction": place.cast("double"), "probability": array_to_vector("p")})


def _evaluator(df, name, **kwargs):
    return MulticlassClassificationEvaluator(metricName=name, **kwargs).evaluate(df)


def test_summary_agrees_with_the_evaluator_of_spark(spark):
    df = _scored(spark)
    counts = evaluate.confusion_counts(df, probability=evaluate.class_probabilities())
    row = evaluate.summary_metrics(counts).first()
    assert row.accuracy == pytest.approx(_evaluator(df, "accuracy"))
    assert row.weighted_precision == pytest.approx(_evaluator(df, "weightedPrecision"))
    assert row.weighted_recall == pytest.approx(_evaluator(df, "weightedRecall"))
    assert row.log_loss == pytest.approx(_evaluator(df, "logLoss"))
    assert row.recall_positive == pytest.approx(_evaluator(df, "recallByLabel", metricLabel=1.0))
    assert row.recall_negative == pytest.approx(_evaluator(df, "recallByLabel", metricLabel=0.0))
    assert evaluate.log_loss(counts).first()[0] == pytest.approx(row.log_loss)
    for r in evaluate.per_class_metrics(counts).collect():
        assert r.precision == pytest.approx(_evaluator(df, "precisionByLabel", metricLabel=r["class"]))
        assert r.recall == pytest.approx(_evaluator(df, "recallByLabel", metricLabel=r["class"]))


def test_classes_never_predicted_or_never_present(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 2.0)], "label double, prediction double")
    counts = evaluate.confusion_counts(df)
    rows = {r["class"]: tuple(r)[1:] for r in evaluate.per_class_metrics(counts).collect()}
    assert rows == {0.0: (2, 2, 1, 0.5, 0.5), 1.0: (1, 0, 0, 0.0, 0.0), 2.0: (0, 1, 0, 0.0, 0.0)}
    row = evaluate.class_metrics(counts).first()
    assert (row.accuracy, row.precision, row.recall) == pytest.approx((1 / 3, 0.0, 0.0))
    assert tuple(evaluate.accuracy(counts).first()) == (3, 1, pytest.approx(1 / 3))


def test_parts_are_kept_apart(spark):
    a = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0)], "label double, prediction double")
    b = spark.createDataFrame([(1, 1), (0, 0), (0, 0)], "label int, prediction int")
    metrics = evaluate.class_metrics(evaluate.count_in_parts({"train": a, "second": b}))
    got = {r.part: (r.n_rows, r.accuracy, r.precision, r.recall) for r in metrics.collect()}
    assert got == {"train": (2, 0.5, 0.5, 1.0), "second": (3, 1.0, 1.0, 1.0)}


def test_log_loss_is_bounded(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 0.0])], "label int, prediction int, p array<double>")
    counts = evaluate.confusion_counts(df, probability=F.col("p"))
    assert evaluate.log_loss(counts).first()[0] == pytest.approx(34.538776, abs=1e-5)


def test_an_empty_table_has_no_metrics(spark):
    df = spark.createDataFrame([], "label double, prediction double")
    row = evaluate.accuracy(evaluate.confusion_counts(df)).first()
    assert row.n_rows is None and row.accuracy == 0.0
