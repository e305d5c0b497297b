"""Whole jobs, from tables to models and metrics.

A job reads its input several times (counting passes over the key, fits, training, scoring), each
time only the columns it needs. Give it a stored table; a derived one is best stored first with
``millrace.session.freeze``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import binary_label
from millrace.operators import boosting, evaluate, logistic, model_walk, models, prepare, profile, sampling
from millrace.session import dealt
from millrace.sources.readers import read_splits
from millrace.sources.writers import write_coefficients, write_csv, write_history, write_splits


# -- tables -------------------------------------------------------------------------------


def train_table(
    three_level: DataFrame, binary: DataFrame, scaled: Sequence[str],
    label_3: str = "Diabetes_012", label: str = "Diabetes_binary", dedup: bool = False,
) -> tuple[DataFrame, prepare.Scaler]:
    """Recode level 2 to 1, rename, append the binary table, z-score some columns."""
    recoded = prepare.rename(prepare.recode(three_level, label_3, {2.0: 1.0}), label_3, label)
    merged = prepare.merge_tables([recoded, binary], dedup)
    scaler = prepare.fit_zscore(merged, scaled)
    return scaler.transform(merged), scaler


def test_table(
    df: DataFrame, scaled: Sequence[str], scaler: prepare.Scaler | None = None, path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The scaled second table and its null flags; with a path the table is written there as CSV.

    Pass the train table's scaler; without one the table is scaled by its own statistics.
    """
    table = (scaler or prepare.fit_zscore(df, scaled)).transform(df)
    if path is not None:
        write_csv(table, path)
    return table, profile.null_flags(table)


def profile_tables(df: DataFrame, label: str, columns: Sequence[str], keys: Sequence[str]) -> dict[str, DataFrame]:
    """Everything a first look at a table shows, each as a small table, from two readings of it."""
    spark = df.sparkSession
    scan = profile.first_scan(df, label, keys)
    shown = list(dict.fromkeys([*columns, label]))
    place = [scan.numeric.index(c) for c in shown]
    shapes = profile.second_scan(df, shown, {k: v[place] for k, v in scan.moments.items()})
    fields = list(scan.schema)
    facts = [(f.name, f.dataType.simpleString(), n, scan.n_rows) for f, n in zip(fields, scan.present, strict=True)]
    kind = scan.schema[label].dataType.simpleString()
    return {
        "head": spark.createDataFrame(scan.head, scan.schema),
        "profile": spark.createDataFrame(facts, "column string, type string, non_null long, n_rows long"),
        "label_counts": spark.createDataFrame(list(scan.label_counts.items()), f"`{label}` {kind}, n long").orderBy(F.desc("n"), F.asc(label)),
        "label_histogram": profile.histogram_table(spark, shapes, [label]),
        "histograms": profile.histogram_table(spark, shapes, columns),
        "null_flags": spark.createDataFrame([(c, n < rows) for c, _, n, rows in facts], "column string, has_null boolean"),
        "correlation": profile.correlation_table(spark, shapes, columns),
    }


# -- training -----------------------------------------------------------------------------


def logistic_job(
    df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
    share: float = 0.8, order: str = "split_first", seed: int = 0,
    lam: float = 0.0, eps: float = 0.1, max_iter: int = 100, alpha: float = 1e-7,
    coefficients_path: str | None = None, history_path: str | None = None,
) -> logistic.Fit:
    """Balance, shuffle, split and train; write weights and history where paths are given.

    ``split_first`` balances the train part only. ``balance_first`` balances the whole table
    before the split, so copies of one row may land in both parts.
    """
    size = sampling.floor_size(share)
    slim = df.select(*keys, label, *features)
    if order == "split_first":
        parts = sampling.split_exact(slim, keys, size, seed)
        rows = sampling.oversample(parts, label, keys, seed, within=F.col("part") == "train")
    elif order == "balance_first":
        balanced = sampling.oversample(slim, label, keys, seed)
        rows = sampling.split_exact(balanced, [*keys, "copy"], size, seed)
    else:
        raise ValueError("order must be 'split_first' or 'balance_first'")
    fit = logistic.train(rows, features, label, F.col("part") == "train", lam, eps, max_iter, alpha)
    if coefficients_path is not None:
        write_coefficients(fit.coefficients_frame(df.sparkSession), coefficients_path)
    if history_path is not None:
        write_history(fit.history_frame(df.sparkSession), history_path)
    return fit


@dataclass(frozen=True)
class Trained:
    """A model, its scored rows with their part, and metrics per part."""

    model: Model | boosting.Boosted | model_walk.Forest
    scored: DataFrame
    counts: DataFrame
    metrics: DataFrame


def _trained(model: Model | boosting.Boosted | model_walk.Forest, scored: DataFrame, counts: DataFrame) -> Trained:
    return Trained(model, scored, counts, evaluate.class_metrics(counts))


def forest_job(
    df: DataFrame, second: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
    share: float = 0.7, trees: int = 20, depth: int = 4, seed: int = 1, partitions: int | None = None,
    subset: str = "auto", bootstrap: bool = True,
) -> Trained:
    """Forest on a Bernoulli split, evaluated on its own two parts and on a second table.

    With ``partitions`` the training rows are dealt out by key first (see ``dealt``), here and in the
    jobs below, so that the model does not depend on how the input is laid out.
    """
    parts = sampling.split_hash(df, keys, share, seed)
    training = dealt(parts.filter("part = 'train'"), keys, partitions)
    model = models.fit_forest(training, features, label, trees, depth, subset=subset, seed=seed, bootstrap=bootstrap)
    columns = [*keys, F.col(label).alias("label"), "part", *features]
    both = parts.select(*columns).unionByName(second.withColumn("part", F.lit("second")).select(*columns))
    scored = models.score(model, both, features)
    return _trained(model, scored, evaluate.confusion_counts(scored, part="part"))


def large_forest_job(
    df: DataFrame, second: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
    test_share: float = 0.25, trees: int = 100, depth: int = 30, seed: int = 101, partitions: int | None = None,
    subset: str = "sqrt", bootstrap: bool = True,
) -> Trained:
    """The same with an exact split and a deeper, larger forest."""
    parts = sampling.split_exact(df, keys, sampling.rest_size(test_share), seed)
    training = dealt(parts.filter("part = 'train'"), keys, partitions)
    model = models.fit_large_forest(training, features, label, trees, depth, seed, subset, bootstrap)
    columns = [*keys, F.col(label).alias("label"), "part", *features]
    both = parts.select(*columns).unionByName(second.withColumn("part", F.lit("second")).select(*columns))
    scored = models.score(model, both, features)
    return _trained(model, scored, evaluate.confusion_counts(scored, part="part"))


def boosted_job(
    df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
    splits_path: str | None = None, seed: int = 2, form: str = "parquet", **settings,
) -> Trained:
    """Boosted trees on a 70/15/15 split. With a path the parts are written there first, as parquet or
    CSV, and training reads the written files. ``settings`` are those of ``boosting.fit``; sums do not
    depend on how rows are laid out."""
    parts = sampling.split_three_way(df.select(*keys, label, *features), keys, seed=seed)
    if splits_path is not None:
        write_splits(parts, splits_path, [*keys, label, *features], form=form)
        parts = read_splits(df.sparkSession, splits_path, parts.schema, form)
    model = boosting.fit(parts.filter("part = 'train'"), features, label, **settings)
    scored = boosting.score(model, parts.withColumnRenamed(label, "label"))
    return _trained(model, scored, evaluate.confusion_counts(scored, part="part"))


def perceptron_job(
    df: DataFrame, features: Sequence[str] | str, label: str, keys: Sequence[str],
    share: float = 0.75, hidden: Sequence[int] = (64, 64), layers: Sequence[int] | None = None,
    inputs: int | None = None, iterations: int = 5, seed: int = 1, partitions: int | None = None,
    initial: Sequence[float] | None = None,
) -> Trained:
    """Perceptron on a Bernoulli split; the metrics also hold log-loss and weighted averages."""
    names = [features] if isinstance(features, str) else list(features)
    one = binary_label(label).alias("label")
    parts = sampling.split_hash(df.select(*keys, one, *names), keys, share, seed)
    model = models.fit_perceptron(
        dealt(parts.filter("part = 'train'"), keys, partitions), features, "label", hidden, inputs, layers=layers,
        iterations=iterations, seed=seed, initial=initial, even=partitions is None,
    )
    scored = models.score(model, parts.filter("part = 'test'"), features)
    counts = evaluate.confusion_counts(
        scored, part="part", probability=evaluate.class_probabilities()
    )
    return Trained(model, scored, counts, evaluate.summary_metrics(counts))


def perceptron_minmax_job(
    df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
    share: float = 0.75, hidden: Sequence[int] = (64, 64), iterations: int = 50, seed: int = 1,
    partitions: int | None = None, initial: Sequence[float] | None = None,
) -> Trained:
    """Perceptron on an exact sample, scaled to the sample's ranges; both parts are evaluated."""
    parts = sampling.split_exact(
        df.select(*keys, F.col(label).alias("label"), *features), keys, sampling.nearest_size(share), seed
    )
    training = F.col("part") == "train"
    scaler = prepare.fit_minmax(parts.filter(training), features)
    # A column that is constant in the sample scales to NULL; it carries nothing, so 0 stands in.
    constant = [c for c, (_, width) in scaler.ranges.items() if width == 0.0]
    scaled = scaler.transform(parts)
    scaled = scaled.fillna(0.0, subset=constant) if constant else scaled
    model = models.fit_perceptron(
        dealt(scaled.filter(training), keys, partitions), features, "label", hidden, iterations=iterations, seed=seed,
        initial=initial, even=partitions is None,
    )
    scored = models.score(model, scaled, features)
    counts = evaluate.confusion_counts(
        scored, part="part", probability=evaluate.class_probabilities()
    )
    return Trained(model, scored, counts, evaluate.summary_metrics(counts))
