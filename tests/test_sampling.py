import hashlib
import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.hashing import cut_at, row_hash
from millrace.operators import sampling


def _hash(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()


def _parts(df):
    return {r.id: r.part for r in df.collect()}


def test_hash_is_md5_of_seed_and_keys(spark):
    df = spark.createDataFrame([(7, "x")], "a int, b string")
    assert df.select(row_hash(["a", "b"], 3)).first()[0] == _hash(3, 7, "x")


def test_cuts():
    assert cut_at(0.5) == "8000000000000" and cut_at(0.0) == "0" * 13 and cut_at(1.0) == "g"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 400), st.floats(0, 1), st.integers(0, 5))
def test_exact_split_takes_the_first_rows_in_hash_order(spark, n, share, seed):
    got = _parts(sampling.split_exact(spark.range(n), ["id"], sampling.floor_size(share), seed))
    order = sorted(range(n), key=lambda i: _hash(seed, i))
    want = {i: "train" if place < int(n * share) else "test" for place, i in enumerate(order)}
    assert got == want


def test_exact_split_of_many_rows(spark):
    """Several counting passes are needed until the cut is between two rows."""
    sizes = Counter(_parts(sampling.split_exact(spark.range(200_000), ["id"], seed=4)).values())
    assert sizes == {"train": 160_000, "test": 40_000}


def test_sizes_follow_the_rule():
    assert sampling.floor_size(0.8)(9) == 7
    assert sampling.nearest_size(0.75)(10) == 8 and sampling.nearest_size(0.75)(6) == 4
    assert sampling.rest_size(0.25)(10) == 7


def test_three_parts(spark):
    sizes = Counter(_parts(sampling.split_three_way(spark.range(1001), ["id"])).values())
    held = math.ceil(1001 * 0.3)
    assert sizes == {"train": 1001 - held, "validation": math.ceil(held / 2), "test": held - math.ceil(held / 2)}


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 0.8, 1.0])
def test_split_is_exact_when_a_third_of_the_rows_share_a_key(spark, share):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"))
    rows = sampling.split_exact(df, ["key"], sampling.floor_size(share)).collect()
    assert Counter(r.part for r in rows) == Counter({"train": int(3000 * share)}) + Counter({"test": 3000 - int(3000 * share)})
    assert sorted(r.id for r in rows) == list(range(3000))
    assert set(rows[0].asDict()) == {"id", "key", "part"}


@pytest.mark.parametrize("parts", [1, 7])
def test_copies_of_the_key_at_the_cut_move_no_other_key(spark, parts):
    order = sorted(range(1000), key=lambda i: _hash(0, i))
    tied = order[799]
    df = spark.range(1000).union(spark.range(tied, tied + 1).crossJoin(spark.range(60)).select(F.lit(tied))).withColumn("x", F.lit(None).cast("int"))
    rows = sampling.split_exact(df.repartition(parts), ["id"], lambda n: 830).collect()
    assert Counter(r.part for r in rows) == {"train": 830, "test": 230}
    assert {r.id: r.part for r in rows if r.id != tied} == {
        i: "train" if place < 799 else "test" for place, i in enumerate(order) if i != tied
    }
    assert Counter(r.part for r in rows if r.id == tied) == {"train": 31, "test": 30}


def test_tied_rows_are_parted_by_their_contents_not_by_their_place(spark):
    df = spark.range(900).select((F.col("id") % 3).alias("key"), (F.col("id") % 250).alias("x"), F.lit(None).alias("y"))
    made = [sampling.split_three_way(df.repartition(n), ["key"]).collect() for n in (1, 4)]
    assert Counter(map(tuple, made[0])) == Counter(map(tuple, made[1]))
    assert Counter(r.part for r in made[0]) == {"train": 630, "test": 135, "validation": 135}


def test_split_of_identical_rows(spark):
    df = spark.range(1000).select(F.lit(1).alias("key"))
    sizes = Counter(r.part for r in sampling.split_exact(df, ["key"]).collect())
    assert sizes == {"train": 800, "test": 200}


def test_hash_split_is_reproducible_and_near_its_share(spark):
    df = spark.range(20_000)
    got = _parts(sampling.split_hash(df, ["id"], 0.7, 5))
    assert got == _parts(sampling.split_hash(df.repartition(13), ["id"], 0.7, 5))
    assert Counter(got.values())["train"] == pytest.approx(14_000, abs=400)
    assert got != _parts(sampling.split_hash(df, ["id"], 0.7, 6))
    assert set(_parts(sampling.split_hash(df, ["id"], 1.0)).values()) == {"train"}
    assert set(_parts(sampling.split_hash(df, ["id"], 0.0)).values()) == {"test"}


def test_sample_and_complement_cover_the_table(spark):
    df = spark.range(1000)
    taken, others = sampling.sample_exact(df, ["id"], 0.75)
    a, b = ({r.id for r in part.collect()} for part in (taken, others))
    assert len(a) == 750 and not a & b and a | b == set(range(1000))
    doubled = taken.union(taken)
    assert {r.id for r in sampling.complement(df, doubled, ["id"]).collect()} == b


def test_shuffle_is_in_hash_order(spark):
    got = [r.id for r in sampling.shuffle_rows(spark.range(500).repartition(6), ["id"], 9).collect()]
    assert got == sorted(range(500), key=lambda i: _hash(9, i))


def test_random_split_covers_the_table(spark):
    parts = sampling.split_random(spark.range(1000), 0.7, seed=3)
    assert sorted(r.id for p in parts for r in p.collect()) == list(range(1000))


# -- balancing ----------------------------------------------------------------------------


def _labelled(spark, pos, neg, other=0):
    label = F.when(F.col("id") < pos, 1).when(F.col("id") < pos + neg, 0)
    return spark.range(pos + neg + other).select("id", label.alias("label"), (F.col("id") * 3).alias("x"))


def _balanced(df, **kwargs):
    return [r.asDict() for r in sampling.oversample(df, "label", ["id"], **kwargs).collect()]


@pytest.mark.parametrize("pos,neg", [(30, 100), (100, 30), (1, 50), (99, 100), (7, 4000), (1, 3000)])
def test_balanced_classes(spark, pos, neg):
    rows = _balanced(_labelled(spark, pos, neg, other=5))
    sizes = Counter(r["label"] for r in rows)
    assert sizes == {1: max(pos, neg), 0: max(pos, neg), None: 5}
    assert sorted(r["id"] for r in rows if r["copy"] == 0) == list(range(pos + neg + 5))
    drawn = [r for r in rows if r["copy"] > 0]
    assert {r["label"] for r in drawn} <= {1 if pos < neg else 0}
    assert len({(r["id"], r["copy"]) for r in rows}) == len(rows)
    assert all(r["x"] == 3 * r["id"] for r in rows)


def test_equal_classes_draw_nothing(spark):
    rows = _balanced(_labelled(spark, 20, 20))
    assert len(rows) == 40 and {r["copy"] for r in rows} == {0}


def test_an_empty_class_is_an_error(spark):
    with pytest.raises(ValueError, match="no row"):
        sampling.oversample(_labelled(spark, 0, 20), "label", ["id"])
    assert sampling.oversample(_labelled(spark, 0, 0), "label", ["id"]).count() == 0


def test_balancing_is_reproducible_and_seeded(spark):
    df = _labelled(spark, 30, 300)
    pick = lambda d, seed: sorted((r["id"], r["copy"]) for r in _balanced(d, seed=seed))
    assert pick(df, 1) == pick(df.repartition(5), 1)
    assert pick(df, 1) != pick(df, 2)


def test_draws_are_spread_like_draws_with_replacement(spark):
    """Counts per row of d draws from m rows have mean d/m and variance d/m * (1 - 1/m)."""
    m, d = 2000, 6000
    rows = _balanced(_labelled(spark, m, m + d))
    counts = Counter(r["id"] for r in rows if r["copy"] > 0)
    per_row = [counts.get(i, 0) for i in range(m)]
    mean = sum(per_row) / m
    variance = sum((c - mean) ** 2 for c in per_row) / m
    assert mean == d / m and variance == pytest.approx(3.0, rel=0.12)
    assert per_row.count(0) / m == pytest.approx(math.exp(-3), abs=0.015)


def test_rows_of_a_part_only(spark):
    df = _labelled(spark, 40, 200).withColumn("part", F.when(F.col("id") % 2 == 0, "train").otherwise("test"))
    rows = _balanced(df, within=F.col("part") == "train")
    sizes = Counter((r["part"], r["label"]) for r in rows)
    assert sizes == {("train", 1): 100, ("train", 0): 100, ("test", 1): 20, ("test", 0): 100}


def test_many_streams_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BLOCK_STREAMS", 7)
    rows = _balanced(_labelled(spark, 2, 900))
    assert Counter(r["label"] for r in rows) == {1: 900, 0: 900}
    assert len({(r["id"], r["copy"]) for r in rows}) == 1800


def test_draws_are_spread_wherever_the_minority_lies(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = _labelled(spark, 2000, 42_000).orderBy("id").coalesce(1)
        drawn = sampling.oversample(df, "label", ["id"]).filter("copy > 0").select(F.spark_partition_id().alias("p"))
        sizes = [r["count"] for r in drawn.groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 40_000 and len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8


def test_rows_of_one_key_draw_by_themselves(spark):
    """Ten keys of 100 equal rows: the draws of a row vary as draws with replacement do."""
    df = _labelled(spark, 1000, 5000).withColumn("row", F.col("id"))
    df = df.withColumn("id", F.when(F.col("label") == 1, F.col("id") % 10).otherwise(F.col("id")))
    counts = Counter(r["row"] for r in _balanced(df) if r["copy"] > 0)
    per_row = [counts.get(i, 0) for i in range(1000)]
    assert sum(per_row) == 4000
    assert sum((c - 4) ** 2 for c in per_row) / 1000 == pytest.approx(4.0, rel=0.2)
    for key in range(10):
        own = per_row[key::10]
        assert len(set(own)) > 3 and 300 < sum(own) < 500


def test_a_wrong_promise_of_unique_keys_is_refused(spark):
    df = _labelled(spark, 30, 100).withColumn("id", F.when(F.col("label") == 1, -1).otherwise(F.col("id")))
    with pytest.raises(ValueError, match="repeat a key"):
        sampling.oversample(df, "label", ["id"], unique=True)


def test_balancing_rows_with_equal_keys(spark):
    """All minority rows share one key: still exact, and whole."""
    df = _labelled(spark, 30, 100).withColumn("id", F.when(F.col("label") == 1, -1).otherwise(F.col("id")))
    rows = _balanced(df)
    assert Counter(r["label"] for r in rows) == {1: 100, 0: 100}
    assert Counter(r["copy"] == 0 for r in rows)[True] == 130


def test_class_sizes(spark):
    row = sampling.class_sizes(_labelled(spark, 3, 8, 2), "label").first()
    assert tuple(row) == (3, 8, 5, 1)
    assert sampling.class_sizes(_labelled(spark, 4, 4), "label").first().minority == 0
