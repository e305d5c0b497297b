"""Whole jobs on small survey-like tables with a learnable label."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import evaluate, prepare
from millrace.plans import jobs
from millrace.session import scratch_path, store_with_row_id
from millrace.sources import readers, writers

FEATURES = list(readers.SURVEY_FEATURES)
SCALED = list(readers.SURVEY_SCALED)
LABEL = readers.SURVEY_LABEL


def _survey(spark, rows, label, levels, seed):
    columns = [(F.rand(seed + i) * (30 if f in SCALED else 1)).alias(f) for i, f in enumerate(FEATURES)]
    df = spark.range(rows).select("id", *columns)
    sick = F.col("HighBP") + F.col("BMI") / 30 > 1.2
    return df.withColumn(label, F.when(sick, (F.col("id") % (levels - 1) + 1).cast("double")).otherwise(0.0))


@pytest.fixture(scope="module")
def survey(spark):
    return _survey(spark, 1500, LABEL, 2, 50).cache()


def test_from_survey_files_without_a_key(spark, tmp_path):
    """CSV files in, models out; many rows are equal and none has a key."""
    three = _survey(spark, 600, readers.SURVEY_LABEL_3, 3, 1).drop("id")
    binary = _survey(spark, 400, LABEL, 2, 90).drop("id")
    files = {name: str(tmp_path / name) for name in ("three", "binary", "train", "beta", "history")}
    writers.write_csv(three.union(three), files["three"])
    writers.write_csv(binary, files["binary"])
    merged, scaler = jobs.train_table(
        readers.read_csv(spark, files["three"]), readers.read_csv(spark, files["binary"]), SCALED
    )
    writers.write_csv(merged, files["train"])
    stored = store_with_row_id(readers.read_csv(spark, files["train"], merged.columns))
    fit = jobs.logistic_job(
        stored, FEATURES, LABEL, ["row_id"], max_iter=6, alpha=1e-3,
        coefficients_path=files["beta"], history_path=files["history"],
    )
    lines = [r.value for r in spark.read.text(files["beta"]).collect()]
    assert [line.split(",")[0] for line in lines] == ["(intercept", *[f"({f}" for f in FEATURES]]
    assert readers.read_parquet(spark, files["history"]).count() == len(fit.history) == 5
    second = scaler.transform(_survey(spark, 200, LABEL, 2, 9).withColumnRenamed("id", "row_id"))
    rows = _metrics(jobs.forest_job(stored, second, FEATURES, LABEL, ["row_id"]))
    assert sum(r.n_rows for r in rows.values()) == 1800 and rows["test"].accuracy > 0.8


def test_train_table(spark):
    three, binary = _survey(spark, 300, readers.SURVEY_LABEL_3, 3, 1), _survey(spark, 200, LABEL, 2, 90)
    table, scaler = jobs.train_table(three, binary, SCALED)
    assert table.count() == 500 and set(scaler.ranges) == set(SCALED)
    assert {r[LABEL] for r in table.select(LABEL).distinct().collect()} == {0.0, 1.0}
    row = table.agg(*[F.avg(c) for c in SCALED], *[F.stddev_pop(c) for c in SCALED]).first()
    assert list(row) == pytest.approx([0, 0, 0, 1, 1, 1], abs=1e-9)
    assert readers.SURVEY_LABEL_3 not in table.columns


def test_test_table_on_either_scale(spark, survey):
    other = _survey(spark, 300, LABEL, 2, 7).withColumn("BMI", F.col("BMI") + 10)
    scaler = prepare.fit_zscore(survey, SCALED)
    on_train, flags = jobs.test_table(other, SCALED, scaler)
    assert on_train.agg(F.avg("BMI")).first()[0] > 0.9
    own, _ = jobs.test_table(other, SCALED)
    assert own.agg(F.avg("BMI")).first()[0] == pytest.approx(0.0, abs=1e-9)
    assert not any(r.has_null for r in flags.collect())


def test_profile_tables(survey):
    shown = jobs.profile_tables(survey, LABEL, FEATURES, ["id"])
    assert shown["head"].count() == 5
    assert shown["histograms"].count() == 210 and shown["label_histogram"].count() == 10
    assert shown["correlation"].count() == 441
    assert shown["profile"].count() == 23 and shown["label_counts"].count() == 2


@pytest.mark.parametrize("order", ["split_first", "balance_first"])
def test_logistic_job_learns(survey, order):
    scaled = prepare.fit_zscore(survey, FEATURES).transform(survey)
    fit = jobs.logistic_job(scaled, FEATURES, LABEL, ["id"], order=order, max_iter=15, alpha=1e-3)
    assert len(fit.beta) == 22 and len(fit.history) == 14
    assert fit.history[-1][1] < fit.history[0][1]
    assert fit.history[-1][7] > 0.85  # test accuracy
    weights = dict(zip(["intercept", *FEATURES], fit.beta))
    assert weights["HighBP"] > 1 and weights["BMI"] > 1 and abs(weights["Sex"]) < 0.5
    with pytest.raises(ValueError):
        jobs.logistic_job(scaled, FEATURES, LABEL, ["id"], order="neither")


def _metrics(trained):
    return {r.part: r for r in trained.metrics.collect()}


def test_forest_jobs(spark, survey):
    second = _survey(spark, 400, LABEL, 2, 333)
    trained = jobs.forest_job(survey, second, FEATURES, LABEL, ["id"])
    rows = _metrics(trained)
    assert set(rows) == {"train", "test", "second"} and rows["second"].n_rows == 400
    assert rows["train"].n_rows + rows["test"].n_rows == 1500
    assert min(r.accuracy for r in rows.values()) > 0.8
    deep = _metrics(jobs.large_forest_job(survey, second, FEATURES, LABEL, ["id"], trees=20, depth=8))
    assert deep["test"].n_rows == 375 and deep["train"].accuracy > deep["test"].accuracy > 0.8


def test_boosted_job_from_written_splits(spark, survey):
    features = list(readers.SURVEY_FEATURES_NO_STATUS)
    path = scratch_path(spark, "splits")
    trained = jobs.boosted_job(survey, features, LABEL, ["id"], path)
    rows = _metrics(trained)
    assert {p: r.n_rows for p, r in rows.items()} == {"train": 1050, "test": 225, "validation": 225}
    assert rows["validation"].accuracy > 0.85
    assert set(readers.read_split(spark, path, "train", ["id", *features]).columns) == {"id", *features}
    again = _metrics(jobs.boosted_job(survey, features, LABEL, ["id"]))
    assert again["test"].accuracy == pytest.approx(rows["test"].accuracy, abs=0.03)


def test_perceptron_jobs(survey):
    scaled = prepare.fit_zscore(survey, FEATURES).transform(survey)
    row = _metrics(jobs.perceptron_job(scaled, FEATURES, LABEL, ["id"], layers=[21, 64, 64, 21], iterations=30))["test"]
    assert row.accuracy > 0.8 and row.log_loss < 0.6 and row.weighted_recall == pytest.approx(row.accuracy)
    trained = jobs.perceptron_minmax_job(survey.withColumn("Sex", F.lit(1.0)), FEATURES, LABEL, ["id"], iterations=40)
    rows = _metrics(trained)
    assert {p: r.n_rows for p, r in rows.items()} == {"train": 1125, "test": 375}
    assert rows["train"].accuracy > 0.8


def test_metrics_can_be_recomputed_from_the_scored_rows(spark, survey):
    trained = jobs.forest_job(survey, survey.limit(0), FEATURES, LABEL, ["id"])
    pairs = [(r.part, r.label == r.prediction) for r in trained.scored.collect()]
    for part, row in _metrics(trained).items():
        hits = Counter(hit for p, hit in pairs if p == part)
        assert row.accuracy == pytest.approx(hits[True] / (hits[True] + hits[False]))
    assert evaluate.accuracy(trained.counts).count() == 2
