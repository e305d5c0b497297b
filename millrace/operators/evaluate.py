"""Metrics of (label, prediction) rows, from one aggregate per table.

``confusion_counts`` groups by part, label and prediction with map-side combine, and sums the
log-loss on the way. Everything after it is arithmetic on those few rows, so a model is applied
once however many metrics are asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG_EPS = 1e-15


def confusion_counts(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    part: str | None = None,
    probability: Column | None = None,
) -> DataFrame:
    """Rows per (part,) label and prediction; with the array of class probabilities also the
    summed log-loss."""
    keys = [F.col(part).alias("part")] if part else []
    keys += [F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")]
    sums = [F.count("*").alias("n")]
    if probability is not None:
        sums.append(F.sum(row_log_loss(probability, label)).alias("loss_sum"))
    return df.groupBy(*keys).agg(*sums)


def row_log_loss(probability: Column, label: str, eps: float = LOG_EPS) -> Column:
    """``-log p`` of the true class, p kept within ``[eps, 1 - eps]``."""
    p = F.element_at(probability, F.col(label).cast("int") + 1)
    return -F.log(F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps)))


def class_probabilities(vector: str = "probability") -> Column:
    """A model's probability vector as an array."""
    return vector_to_array(F.col(vector))


def count_in_parts(tables: dict[str, DataFrame], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion counts of several scored tables, keyed by part, each reduced before the union."""
    counts = [
        confusion_counts(df, label, prediction).withColumn("part", F.lit(name)) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _parts(counts: DataFrame) -> list[str]:
    return ["part"] if "part" in counts.columns else []


def _share(part: Column, whole: Column) -> Column:
    """0 where the whole is empty."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def _total(when: Column) -> Column:
    return F.sum(F.when(when, F.col("n")).otherwise(0))


def accuracy(counts: DataFrame) -> DataFrame:
    """Rows, rows whose prediction equals the label, and their share."""
    hits = _total(F.col("label") == F.col("prediction"))
    return counts.groupBy(*_parts(counts)).agg(
        F.sum("n").alias("n_rows"), hits.alias("n_equal"), _share(hits, F.sum("n")).alias("accuracy")
    )


def per_class_metrics(counts: DataFrame) -> DataFrame:
    """Sizes, hits, precision and recall of each class that occurs as label or prediction."""
    n, none = F.col("n"), F.lit(0).cast("long")
    same = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)
    sides = F.array(
        F.struct(F.col("label").alias("class"), n.alias("actual"), none.alias("predicted"), same.alias("hits")),
        F.struct(F.col("prediction").alias("class"), none.alias("actual"), n.alias("predicted"), none.alias("hits")),
    )
    sums = [F.sum(c).alias(c) for c in ("actual", "predicted", "hits")]
    classes = counts.select(*_parts(counts), F.inline(sides)).groupBy(*_parts(counts), "class").agg(*sums)
    return classes.select(
        "*",
        _share(F.col("hits"), F.col("predicted")).alias("precision"),
        _share(F.col("hits"), F.col("actual")).alias("recall"),
    )


def class_metrics(counts: DataFrame, positive: float = 1.0) -> DataFrame:
    """Accuracy, and precision and recall of one class, one row per part."""
    label, prediction = F.col("label"), F.col("prediction")
    hits = _total((label == positive) & (prediction == positive))
    return counts.groupBy(*_parts(counts)).agg(
        F.sum("n").alias("n_rows"),
        _share(_total(label == prediction), F.sum("n")).alias("accuracy"),
        _share(hits, _total(prediction == positive)).alias("precision"),
        _share(hits, _total(label == positive)).alias("recall"),
    )


def summary_metrics(counts: DataFrame, positive: float = 1.0, negative: float = 0.0) -> DataFrame:
    """Accuracy, weighted precision and recall, recall of two classes and, if summed, log-loss.

    Weights are the actual class sizes. A class without hits adds nothing to either average, so
    the rows on the diagonal are enough; the windows run over the counts, not over the table.
    """
    label, prediction, n = F.col("label"), F.col("prediction"), F.col("n")
    by_label = Window.partitionBy(*_parts(counts), "label")
    by_prediction = Window.partitionBy(*_parts(counts), "prediction")
    sized = counts.withColumns(
        {"actual": F.sum("n").over(by_label), "predicted": F.sum("n").over(by_prediction)}
    )
    same, total = label == prediction, F.sum("n")
    metrics = [
        total.alias("n_rows"),
        _share(_total(same), total).alias("accuracy"),
        _share(F.sum(F.when(same, F.col("actual") * n / F.col("predicted"))), total).alias("weighted_precision"),
        _share(F.sum(F.when(same, n)), total).alias("weighted_recall"),
        _share(_total(same & (label == positive)), _total(label == positive)).alias("recall_positive"),
        _share(_total(same & (label == negative)), _total(label == negative)).alias("recall_negative"),
    ]
    if "loss_sum" in counts.columns:
        metrics.append(F.try_divide(F.sum("loss_sum"), total).alias("log_loss"))
    return sized.groupBy(*_parts(counts)).agg(*metrics)


def log_loss(counts: DataFrame) -> DataFrame:
    """Mean log-loss of counts that carry its sum."""
    return counts.groupBy(*_parts(counts)).agg(
        F.try_divide(F.sum("loss_sum"), F.sum("n")).alias("log_loss")
    )
