"""Queries on losses, gradients, scores and logistic training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import binary_label
from millrace.operators import evaluate, logistic, prepare
from millrace.plans import jobs
from millrace.plans.registry import (
    FF,
    FL,
    FLOOR_80,
    ORDER_FEATURES,
    descent,
    history_rows,
    long_descent,
    oversampled,
    query,
    r,
    rounded,
    split_at,
    zscored,
)
from millrace.session import freeze, scratch_path
from millrace.sources import frames, readers
from millrace.sources.frames import LINE_FEATURES

# A fixed weight vector for the line frame: it predicts both classes.
BETA = [-0.9, 0.02, 0.0000137913, 2.0, -3.0]
LAM = 0.1

_Z = " + ".join([f"({BETA[0]}::DOUBLE)", *[f"{b}::DOUBLE * {c}" for b, c in zip(BETA[1:], LINE_FEATURES)]])
_SCORED = f"""{FL}, sc AS (SELECT *, {_Z} AS z, CASE WHEN label = 0 THEN -1 ELSE label END AS y,
  CASE WHEN l_quantity <= 40 THEN 'train' ELSE 'test' END AS part FROM fl)"""
_SIZE = " + ".join(f"{b}::DOUBLE * {b}::DOUBLE" for b in BETA)


def _line_rows(spark: SparkSession, folder: str) -> logistic.Rows:
    return logistic.prepare_rows(frames.line_frame(spark, folder), LINE_FEATURES, "label")


@query(f"""WITH {_SCORED} SELECT {r(f"sum(ln(1 + exp(-y * z))) + {LAM}::DOUBLE * ({_SIZE})", 'loss', 3)} FROM sc""")
def logistic_loss(spark: SparkSession, folder: str) -> DataFrame:
    value = logistic.total_loss(_line_rows(spark, folder), BETA, LAM)
    return spark.createDataFrame([(value,)], "loss double").select(F.round("loss", 3).alias("loss"))


_GRADIENT = " UNION ALL ".join(
    f"""SELECT '{term}' AS term, {r(f"sum(slope * {x}) + 2 * {LAM}::DOUBLE * {b}::DOUBLE", 'value', 1)} FROM sl"""
    for term, x, b in zip(["intercept", *LINE_FEATURES], ["1", *LINE_FEATURES], BETA)
)


@query(f"WITH {_SCORED}, sl AS (SELECT *, -y / (1 + exp(y * z)) AS slope FROM sc) {_GRADIENT}")
def logistic_gradient(spark: SparkSession, folder: str) -> DataFrame:
    gradient = logistic.total_gradient(_line_rows(spark, folder), BETA, LAM)
    return rounded(logistic.vector_frame(spark, LINE_FEATURES, gradient), ["value"], 1).drop("position")


def _squared_hinge(y: Column, z: Column) -> Column:
    return F.pow(F.greatest(F.lit(1.0) - y * z, F.lit(0.0)), 2)


def _squared_hinge_slope(y: Column, z: Column) -> Column:
    return F.lit(-2.0) * y * F.greatest(F.lit(1.0) - y * z, F.lit(0.0))


@query(f"""WITH {_SCORED}, sl AS (SELECT *, -2 * y * greatest(1 - y * z, 0) AS slope FROM sc) {_GRADIENT}""")
def pluggable_loss_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """The same pass with another loss, given as two column builders."""
    loss = logistic.Loss(_squared_hinge, _squared_hinge_slope)
    rows = logistic.prepare_rows(frames.line_frame(spark, folder), LINE_FEATURES, "label", loss=loss)
    gradient = logistic.total_gradient(rows, BETA, LAM)
    return rounded(logistic.vector_frame(spark, LINE_FEATURES, gradient), ["value"], 1).drop("position")


EMBEDDING_WIDTH = 64


@query(f"""WITH e AS (SELECT vec_id, CASE WHEN label = 0 THEN 1 ELSE -1 END AS y, embedding::DOUBLE[] AS x FROM embeddings),
sl AS (SELECT *, -y / (1 + exp(y * (0.1::DOUBLE + list_sum(list_transform(x, lambda v: 0.05::DOUBLE * v))))) AS slope FROM e),
g AS (SELECT slope, unnest(list_concat([1.0::DOUBLE], x)) AS v, unnest(range({EMBEDDING_WIDTH + 1})) AS position FROM sl)
SELECT position::INTEGER AS position, {r('sum(slope * v)', 'value', 5)} FROM g GROUP BY position""")
def logistic_gradient_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Array features: tasks add up their Arrow batches."""
    rows = logistic.prepare_rows(frames.embedding_frame(spark, folder), "embedding", "label")
    gradient = logistic.total_gradient(rows, [0.1, *[0.05] * rows.width])
    names = [f"e{j}" for j in range(rows.width)]
    return rounded(logistic.vector_frame(spark, names, gradient), ["value"], 5).drop("term")


# -- scores and smoothed metrics ------------------------------------------------------------


def _scored_lines(spark: SparkSession, folder: str) -> DataFrame:
    part = F.when(F.col("l_quantity") <= 40, "train").otherwise("test")
    return logistic.score(frames.line_frame(spark, folder), LINE_FEATURES, BETA).withColumn("part", part)


@query(f"WITH {_SCORED} SELECT label, {r('z', 'score')}, sign(z)::INTEGER AS prediction FROM sc")
def logistic_score(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_scored_lines(spark, folder).select("label", "score", "prediction"), ["score"])


_CELLS = """count(*) FILTER (WHERE z > 0 AND y = 1) + 1 AS tp, count(*) FILTER (WHERE z > 0 AND y = -1) + 1 AS fp,
count(*) FILTER (WHERE z < 0 AND y = -1) + 1 AS tn, count(*) FILTER (WHERE z < 0 AND y = 1) + 1 AS fn"""


@query(f"""WITH {_SCORED} SELECT part, (tp + fp)::DOUBLE AS p, (tn + fn)::DOUBLE AS n, tp::DOUBLE AS tp,
fp::DOUBLE AS fp, tn::DOUBLE AS tn, fn::DOUBLE AS fn FROM (SELECT part, {_CELLS} FROM sc GROUP BY part)""")
def confusion_smoothed(spark: SparkSession, folder: str) -> DataFrame:
    return logistic.confusion(_scored_lines(spark, folder), "label", "score", "part")


@query(f"""WITH {_SCORED} SELECT part, {r("(tp + tn) / (tp + fp + tn + fn)::DOUBLE", 'accuracy')},
{r("tp / (tp + fp)::DOUBLE", 'precision')}, {r("tp / (tp + fn)::DOUBLE", 'recall')}
FROM (SELECT part, {_CELLS} FROM sc GROUP BY part)""")
def binary_metrics_smoothed(spark: SparkSession, folder: str) -> DataFrame:
    counts = logistic.confusion(_scored_lines(spark, folder), "label", "score", "part")
    return rounded(logistic.smoothed_metrics(counts), ["accuracy", "precision", "recall"])


@query("""SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END::INTEGER AS label,
CASE WHEN value > 20 THEN 1 ELSE 0 END::INTEGER AS prediction FROM events""")
def pair_labels_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Labels and predictions stored apart, paired by key."""
    df = frames.event_frame(spark, folder)
    predictions = df.select("event_id", F.when(F.col("value") > 20, 1).otherwise(0).alias("prediction"))
    return df.select("event_id", "label").join(predictions, "event_id", "inner")


# -- training -----------------------------------------------------------------------------

_ZS = zscored("ff", "zs", ORDER_FEATURES, "o_orderkey, label")
_BALANCED = f"""{FF}, {_ZS}, {split_at('zs', 'sp', 'o_orderkey', FLOOR_80)},
{oversampled('sp', 'os', 'o_orderkey', "part = 'train'")},
tr AS (SELECT *, CASE WHEN label = 0 THEN -1 ELSE label END AS y FROM os)"""
_ALPHA = "1.0::DOUBLE / (SELECT count(*) FROM orders)"
UPDATES = 3


def _training_frame(spark: SparkSession, folder: str) -> DataFrame:
    df = freeze(frames.order_frame(spark, folder))
    return prepare.fit_zscore(df, ORDER_FEATURES).transform(df)


def _step(spark: SparkSession, folder: str) -> float:
    return 1.0 / frames.table(spark, folder, "orders").count()


def _fit(spark: SparkSession, folder: str, max_iter: int = UPDATES + 1, eps: float = 0.1, **paths: str) -> logistic.Fit:
    return jobs.logistic_job(
        _training_frame(spark, folder), ORDER_FEATURES, "label", ["o_orderkey"],
        lam=LAM, eps=eps, max_iter=max_iter, alpha=_step(spark, folder), **paths,
    )


_RATES = [f"{p}_{m}" for p in ("train", "test") for m in ("accuracy", "precision", "recall")]


def _rounded_history(history: DataFrame) -> DataFrame:
    history = rounded(history, ["loss", "grad_norm"], 4)
    return rounded(history, _RATES).select("iteration", "loss", "grad_norm", *_RATES)


_TERMS = ["intercept", *ORDER_FEATURES]


@query(f"WITH {_BALANCED}, {descent('tr', ORDER_FEATURES, _ALPHA, LAM, UPDATES)} " + " UNION ALL ".join(
    f"SELECT {j}::INTEGER AS position, '{t}' AS term, {r(f'w{j}', 'value')} FROM b{UPDATES}" for j, t in enumerate(_TERMS)))
def logistic_train(spark: SparkSession, folder: str) -> DataFrame:
    """Weights after three updates on the split and balanced orders."""
    return rounded(_fit(spark, folder).coefficients_frame(spark), ["value"])


_ALL_UPDATES = 99  # as many as the reference settings allow


@query(f"""WITH RECURSIVE {_BALANCED}, {long_descent('tr', ORDER_FEATURES, _ALPHA, LAM, _ALL_UPDATES, 0.1)}
{history_rows(None)}""")
def logistic_history(spark: SparkSession, folder: str) -> DataFrame:
    """One row per update of the whole descent: loss, gradient norm and both parts' metrics."""
    return _rounded_history(_fit(spark, folder, max_iter=_ALL_UPDATES + 1).history_frame(spark))


@query(f"WITH {_BALANCED}, {descent('tr', ORDER_FEATURES, _ALPHA, LAM, UPDATES)} {history_rows(UPDATES)}")
def history_file(spark: SparkSession, folder: str) -> DataFrame:
    """The same, written and read back."""
    path = scratch_path(spark, "history")
    _fit(spark, folder, history_path=path)
    return _rounded_history(readers.read_parquet(spark, path))


_LEAKY = f"""{FF}, {_ZS}, {oversampled('zs', 'os', 'o_orderkey')},
{split_at('os', 'sp', "o_orderkey || ':' || copy", FLOOR_80)},
tr AS (SELECT *, CASE WHEN label = 0 THEN -1 ELSE label END AS y FROM sp)"""


@query(f"WITH {_LEAKY}, {descent('tr', ORDER_FEATURES, _ALPHA, LAM, UPDATES)} {history_rows(UPDATES)}")
def logistic_balance_first(spark: SparkSession, folder: str) -> DataFrame:
    """The order of steps in which copies reach the test part."""
    fit = jobs.logistic_job(
        _training_frame(spark, folder), ORDER_FEATURES, "label", ["o_orderkey"], order="balance_first",
        lam=LAM, max_iter=UPDATES + 1, alpha=_step(spark, folder),
    )
    return _rounded_history(fit.history_frame(spark))


# Norms below which the descent ends long before its updates are used up, and never.
_EPS = "(SELECT 0.0005::DOUBLE * count(*) FROM orders)"


@query(f"""WITH RECURSIVE {_BALANCED}, {long_descent('tr', ORDER_FEATURES, _ALPHA, LAM, _ALL_UPDATES, _EPS)},
{descent('tr', ORDER_FEATURES, _ALPHA, LAM, UPDATES)}
SELECT 'early' AS run, max(k)::INTEGER + 1 AS iterations, min(norm) < any_value({_EPS}) AS converged,
  {r("arg_max(norm, k)", "last_norm", 4)} FROM bs
UNION ALL SELECT 'short', 4, norm < 0.1, {r("norm", "last_norm", 4)} FROM b{UPDATES}""")
def logistic_convergence(spark: SparkSession, folder: str) -> DataFrame:
    """One run that ends by its gradient norm, and one by its number of updates."""
    small = 0.0005 * frames.table(spark, folder, "orders").count()
    fits = {"early": _fit(spark, folder, _ALL_UPDATES + 1, small), "short": _fit(spark, folder)}
    rows = [(run, fit.iterations, fit.converged, fit.history[-1][2]) for run, fit in fits.items()]
    return rounded(spark.createDataFrame(rows, "run string, iterations int, converged boolean, last_norm double"), ["last_norm"], 4)


@query(f"WITH {_BALANCED}, {descent('tr', ORDER_FEATURES, _ALPHA, LAM, UPDATES)} " + " UNION ALL ".join(
    f"SELECT '({t},' || printf('%.6f', w{j}) || ')' AS line FROM b{UPDATES}" for j, t in enumerate(_TERMS)))
def coefficients_file(spark: SparkSession, folder: str) -> DataFrame:
    """Weights written as text lines and read back."""
    path = scratch_path(spark, "coefficients")
    _fit(spark, folder, coefficients_path=path)
    return spark.read.text(path).withColumnRenamed("value", "line")


# -- metrics of a fixed scorer ----------------------------------------------------------------

_PREDICTED = f"""{_SCORED}, pr AS (SELECT *, CASE WHEN z > 0 THEN 1 ELSE 0 END AS prediction,
  1 / (1 + exp(-z)) AS p1 FROM sc)"""


def _predicted_lines(spark: SparkSession, folder: str) -> DataFrame:
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("score")))
    return _scored_lines(spark, folder).withColumns(
        {"prediction": binary_label("prediction"), "probability": F.array(F.lit(1.0) - p1, p1)}
    )


@query(f"""WITH {_PREDICTED} SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = prediction) AS n_equal,
{r("avg((label = prediction)::INTEGER)", 'accuracy')} FROM pr""")
def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.accuracy(evaluate.confusion_counts(_predicted_lines(spark, folder))), ["accuracy"])


_LOSS = "-ln(greatest(least(CASE label WHEN 1 THEN p1 ELSE 1 - p1 END, 1 - 1e-15), 1e-15))"


@query(f"WITH {_PREDICTED} SELECT part, {r(f'avg({_LOSS})', 'log_loss')} FROM pr GROUP BY part")
def log_loss(spark: SparkSession, folder: str) -> DataFrame:
    counts = evaluate.confusion_counts(
        _predicted_lines(spark, folder), part="part", probability=F.col("probability")
    )
    return rounded(evaluate.log_loss(counts), ["log_loss"])


@query(f"""WITH {_PREDICTED} SELECT part, count(*) AS n_rows, {r("avg((label = prediction)::INTEGER)", 'accuracy')},
{r("count(*) FILTER (WHERE label = 1 AND prediction = 1) / count(*) FILTER (WHERE prediction = 1)::DOUBLE", 'precision')},
{r("count(*) FILTER (WHERE label = 1 AND prediction = 1) / count(*) FILTER (WHERE label = 1)::DOUBLE", 'recall')}
FROM (SELECT part, label, prediction FROM pr UNION ALL SELECT 'second',
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END, CASE WHEN value > 20 THEN 1 ELSE 0 END FROM events)
GROUP BY part""")
def metrics_by_part(spark: SparkSession, folder: str) -> DataFrame:
    """Two parts of one table and a second table."""
    lines = _predicted_lines(spark, folder)
    tables = {p: lines.filter(F.col("part") == p) for p in ("train", "test")}
    tables["second"] = pair_labels_predictions(spark, folder)
    metrics = evaluate.class_metrics(evaluate.count_in_parts(tables))
    return rounded(metrics, ["accuracy", "precision", "recall"])


# Ten classes: the place of the largest entry, modulo ten, stands for a prediction.
_TEN = """em AS (SELECT label, (list_position(embedding, list_max(embedding)) - 1) % 10 AS prediction FROM embeddings),
cl AS (SELECT DISTINCT unnest([label, prediction]) AS class FROM em),
pc AS (SELECT class, (SELECT count(*) FROM em WHERE label = class) AS actual,
  (SELECT count(*) FROM em WHERE prediction = class) AS predicted,
  (SELECT count(*) FROM em WHERE label = class AND prediction = class) AS hits FROM cl),
ra AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted::DOUBLE END AS precision,
  CASE WHEN actual = 0 THEN 0 ELSE hits / actual::DOUBLE END AS recall FROM pc)"""


def _ten_classes(spark: SparkSession, folder: str) -> DataFrame:
    place = (F.array_position("embedding", F.array_max("embedding")) - 1) % 10
    return frames.table(spark, folder, "embeddings").select("label", place.alias("prediction"))


@query(f"""WITH {_TEN} SELECT class::DOUBLE AS class, actual, predicted, hits, {r('precision', 'precision')},
{r('recall', 'recall')} FROM ra""")
def per_class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluate.per_class_metrics(evaluate.confusion_counts(_ten_classes(spark, folder)))
    return rounded(metrics, ["precision", "recall"])


@query(f"""WITH {_TEN} SELECT sum(actual)::BIGINT AS n_rows, {r('sum(hits) / sum(actual)', 'accuracy')},
{r('sum(actual * precision) / sum(actual)', 'weighted_precision')},
{r('sum(actual * recall) / sum(actual)', 'weighted_recall')},
{r('any_value(recall) FILTER (WHERE class = 1)', 'recall_positive')},
{r('any_value(recall) FILTER (WHERE class = 0)', 'recall_negative')} FROM ra""")
def weighted_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluate.summary_metrics(evaluate.confusion_counts(_ten_classes(spark, folder)))
    return rounded(metrics, [c for c in metrics.columns if c != "n_rows"])
