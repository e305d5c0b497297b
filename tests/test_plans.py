"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import evaluate, logistic, prepare, profile, sampling
from millrace.plans.catalog import QUERIES
from millrace.sources import frames


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", plan))


@pytest.fixture(scope="module")
def orders(spark, folder):
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    return frames.table(spark, folder, "orders").select("o_orderkey", urgent.alias("label"), "o_totalprice")


def test_splits_scale_and_score_move_no_rows(orders):
    key = ["o_orderkey"]
    for df in (
        sampling.split_exact(orders, key),
        sampling.split_three_way(orders, key),
        sampling.split_hash(orders, key),
        prepare.fit_zscore(orders, ["o_totalprice"]).transform(orders),
        logistic.score(orders, ["o_totalprice"], [0.1, 0.2]),
    ):
        plan = _plan(df)
        assert _exchanges(plan) == 0 and plan.count("FileScan") == 1


def test_balancing_deals_out_the_minority_only(orders):
    split = sampling.split_exact(orders, ["o_orderkey"])
    for df in (
        sampling.oversample(orders, "label", ["o_orderkey"]),
        sampling.oversample(split, "label", ["o_orderkey"], within=F.col("part") == "train"),
    ):
        plan = _plan(df)
        assert _exchanges(plan) == 1 and plan.count("FileScan") == 2
        assert re.search(r"Exchange hashpartitioning.*\n(.*\n)*?.*Filter.*= 1", plan)


def test_a_profile_is_two_readings(spark, folder, monkeypatch):
    from millrace.operators import gather
    from millrace.plans import jobs

    calls = []
    real = gather.gather
    for module in (gather, profile):
        monkeypatch.setattr(module, "gather", lambda df, *rest: calls.append(_plan(df).count("FileScan")) or real(df, *rest))
    lines = frames.table(spark, folder, "lineitem").select("l_orderkey", *frames.LINE_FEATURES)
    shown = jobs.profile_tables(lines, "l_tax", frames.LINE_FEATURES, ["l_orderkey"])
    assert calls == [1, 1] and len(shown) == 7
    assert all("FileScan" not in _plan(df) for df in shown.values())


def test_many_columns_are_scaled_in_one_reading(spark, folder, monkeypatch):
    from millrace.operators import gather

    plans = []
    real = gather.gather
    monkeypatch.setattr(gather, "gather", lambda df, *rest: plans.append(_plan(df)) or real(df, *rest))
    lines = frames.line_frame(spark, folder)
    many = lines.select([(F.col("l_quantity") * i).alias(f"c{i}") for i in range(21)])
    prepare.fit_zscore(many, many.columns)
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and "Exchange" not in plans[0] and "Aggregate" not in plans[0]


def test_counting_passes_read_the_key_only(orders, monkeypatch):
    seen = []
    real = sampling._prefix_counts
    monkeypatch.setattr(sampling, "_prefix_counts", lambda df, n: seen.append(_plan(df)) or real(df, n))
    sampling.split_exact(orders, ["o_orderkey"])
    assert seen and all("ReadSchema: struct<o_orderkey:bigint>" in plan for plan in seen)


def test_hash_split_filters_after_reading_needed_columns(orders):
    train = sampling.split_hash(orders, ["o_orderkey"]).filter("part = 'train'").select("o_totalprice")
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in _plan(train)


def test_aggregates_combine_before_the_shuffle(orders, spark, folder):
    lines = frames.line_frame(spark, folder)
    scored = logistic.score(lines, frames.LINE_FEATURES, [0.1] * 5)
    for df in (
        evaluate.confusion_counts(scored),
        profile.value_counts(orders, "label"),
        logistic.confusion(scored, "label"),
    ):
        assert re.search(r"partial_count", _plan(df))


def test_metrics_scan_the_table_once(spark, folder):
    scored = logistic.score(frames.line_frame(spark, folder), frames.LINE_FEATURES, [0.1] * 5)
    counts = evaluate.confusion_counts(scored)
    for df in (evaluate.summary_metrics(counts), evaluate.per_class_metrics(counts), evaluate.class_metrics(counts)):
        assert _plan(df).count("FileScan") == 1


def test_facts_scan_the_table_once(spark, folder):
    lines = frames.line_frame(spark, folder)
    for df in (profile.table_profile(lines), profile.null_flags(lines)):
        assert _plan(df).count("FileScan") == 1


def test_head_is_a_top_n(orders):
    assert "TakeOrderedAndProject" in _plan(profile.head_rows(orders, ["o_orderkey"]))


def test_documents_are_read_without_their_text(spark, folder):
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", _plan(frames.doc_frame(spark, folder)))
    assert sorted(scans) == ["doc_id:bigint,n_chars:bigint", "doc_id:bigint,quality:int,toxic:int"]


def test_a_pass_is_one_generated_stage(spark, folder):
    rows = logistic.prepare_rows(frames.line_frame(spark, folder), frames.LINE_FEATURES, "label")
    z = F.expr("0.1D + `x1`").alias("z")
    df = rows.df.select("*", z).select(*rows.steps).agg(*rows.sums.values())
    tree = _plan(df)
    assert tree.count("HashAggregate") == 2 and _exchanges(tree) == 1 and "ObjectHashAggregate" not in tree


FEW = ["split_exact", "oversample", "metrics_by_part", "zscore_from_train",
       "join_features_labels", "complement_by_key", "weighted_metrics", "shuffle_rows", "merge_by_name", "profile_job"]


@pytest.mark.parametrize("name", FEW)
def test_no_cross_join_and_no_single_task_window(spark, folder, name):
    plan = _plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "rangepartitioning" in plan or name != "shuffle_rows"
