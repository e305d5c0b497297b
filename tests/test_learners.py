"""Boosting against a plain version, and models applied apart from their classes."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from millrace.operators import boosting, evaluate, model_walk, models
from millrace.plans.learner_sql import formula_weights

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=900), rng.integers(0, 5, 900), np.full(900, 2.0)])
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 2)).astype(int)
    y = np.where(rng.random(900) < 0.1, 1 - y, y)
    made = [(k, *map(float, x[k]), int(y[k]), ("train", "test")[k % 4 == 0]) for k in range(900)]
    return spark.createDataFrame(made, "id long, a double, b double, c double, label int, part string").cache()


def _plain(x, y, rounds, rate, leaves, depth, bins, least, l2, grow):
    """Boosting by the book: every split tried on the rows themselves."""
    n = len(x)
    cuts = [sorted({sorted(x[:, f])[math.ceil(k * n / bins) - 1] for k in range(1, bins)}) for f in range(x.shape[1])]
    margin, steps = np.zeros(n), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        parts, tree = {0: (np.arange(n), 0)}, []
        value = lambda own: g[own].sum() ** 2 / (h[own].sum() + l2)
        while len(parts) < leaves:
            found = []
            for leaf, (own, level) in parts.items():
                best = None
                for f in range(x.shape[1]):
                    for cut in cuts[f]:
                        low, high = own[x[own, f] <= cut], own[x[own, f] > cut]
                        if min(h[low].sum(), h[high].sum()) >= least:
                            gain = value(low) + value(high) - value(own)
                            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                                best = (gain, f, cut)
                if best and level < depth:
                    found.append((level if grow == "depth" else 0, -best[0], leaf, *best[1:]))
            if not found:
                break
            *_, leaf, f, cut = min(found)
            own, level = parts[leaf]
            parts[leaf], parts[len(parts)] = (own[x[own, f] <= cut], level + 1), (own[x[own, f] > cut], level + 1)
            tree.append((leaf, f, cut))
        for own, _ in parts.values():
            margin[own] -= rate * g[own].sum() / (h[own].sum() + l2)
        steps.append((tree, margin.copy()))
    return steps


@pytest.mark.parametrize(("grow", "leaves", "depth"), [("best", 4, 6), ("depth", 4, 6), ("best", 7, 2), ("depth", 6, 6), ("best", 1, 6)])
def test_boosting_against_a_plain_version(rows, grow, leaves, depth):
    local = rows.orderBy("id").toPandas()
    x, y = local[NAMES].to_numpy(), local["label"].to_numpy()
    settings = {"rounds": 4, "leaves": leaves, "depth": depth, "grow": grow}
    steps = _plain(x, y, 4, 0.35, leaves, depth, 8, 6.0, 1.0, grow)
    model = boosting.fit(rows, NAMES, accuracy=100_000, **settings)
    trees = [[(leaf, f, model.cuts[f][cut]) for leaf, f, cut in tree.splits] for tree in model.trees]
    assert trees == [tree for tree, _ in steps]
    found = boosting.score(model, rows.repartition(5)).orderBy("id").toPandas()
    assert found["margin"].to_numpy() == pytest.approx(steps[-1][1], abs=1e-9)
    assert (found["prediction"] == (steps[-1][1] > 0)).all()
    assert found["probability"].to_numpy() == pytest.approx(1 / (1 + np.exp(-steps[-1][1])), abs=1e-9)


def test_boosting_curve(rows):
    model = boosting.fit(rows.filter("part = 'train'"), NAMES, rounds=5)
    points = {(r.part, r.iteration): r for r in boosting.curve(model, rows).collect()}
    assert set(points) == {(p, k) for p in ("train", "test") for k in range(6)}
    assert points["train", 0].log_loss == pytest.approx(math.log(2)) and points["test", 0].n_rows == 225
    losses = [points["train", k].log_loss for k in range(6)]
    assert losses == sorted(losses, reverse=True)
    counts = evaluate.confusion_counts(boosting.score(model, rows), part="part")
    last = {r.part: r.accuracy for r in evaluate.accuracy(counts).collect()}
    assert {p: points[p, 5].accuracy for p in last} == pytest.approx(last)


def test_boosting_refuses_missing_values_and_unknown_orders(spark, rows):
    with pytest.raises(Exception, match="missing value"):
        boosting.fit(spark.createDataFrame([(1, 1.0), (0, None)], "label int, a double"), ["a"])
    with pytest.raises(ValueError, match="grow"):
        boosting.fit(rows, NAMES, grow="wide")


def test_boosting_of_one_class_and_of_constant_features(spark):
    df = spark.createDataFrame([(1, 1.0)] * 40, "label int, a double")
    model = boosting.fit(df, ["a"], rounds=3)
    assert all(not tree.splits for tree in model.trees)
    assert boosting.score(model, df).first().probability > 0.5


@pytest.mark.parametrize("trees", [1, 12])
def test_a_stored_forest_walks_like_the_model(spark, rows, trees):
    model = models.fit_forest(rows, NAMES, trees=trees, depth=6)
    nodes = model_walk.node_table(spark, model)
    assert nodes.filter("left < 0").count() == nodes.filter("threshold IS NULL").count() > 0
    read = model_walk.Trees.read(nodes)
    both = model_walk.walk(models.score(model, rows, NAMES), read, NAMES, "walked")
    for r in both.collect():
        assert list(r.probability) == pytest.approx(r.walked, abs=1e-12)
    assert model_walk.walk(rows.limit(0), read, NAMES).count() == 0
    with pytest.raises(Exception, match="NULL"):
        model_walk.walk(rows.withColumn("b", F.lit(None).cast("double")), read, NAMES).collect()


def test_a_single_stored_tree(spark, rows):
    model = DecisionTreeClassifier(maxDepth=3).fit(models.vectors(rows, NAMES))
    read = model_walk.Trees.read(model_walk.node_table(spark, model))
    paths = read.paths()
    assert paths[0]["path"] == 1 and sum(paths[0]["counts"]) == 900
    children = {n["path"] for n in paths}
    assert all({2 * n["path"], 2 * n["path"] + 1} <= children for n in paths if n["threshold"] is not None)
    walked = model_walk.walk(models.score(model, rows, NAMES), read, NAMES, "walked")
    assert all(list(r.probability) == pytest.approx(r.walked) for r in walked.collect())


def test_a_perceptron_from_its_weights(rows):
    model = models.fit_perceptron(rows, NAMES, hidden=(7, 5), outputs=3, iterations=4)
    inputs = F.array(*[F.col(c) for c in NAMES])
    weights, layers = model.weights.toArray().tolist(), list(model.getLayers())
    both = model_walk.feed_forward(models.score(model, rows, NAMES), inputs, weights, layers, "walked")
    assert all(list(r.probability) == pytest.approx(r.walked, abs=1e-12) for r in both.collect())
    with pytest.raises(ValueError, match="fit the layers"):
        model_walk.feed_forward(rows, inputs, weights[1:], layers)


def test_a_perceptron_is_walked_in_compiled_functions(spark):
    """No sum is a function over array elements, which are not compiled; a missing input leaves no probability."""
    layers, df = [3, 6, 4, 2], spark.createDataFrame([(1, [0.5, -1.0, 2.0]), (2, [0.5, None, 2.0])], "id long, x array<double>")
    walked = model_walk.feed_forward(df, F.col("x"), formula_weights(layers), layers)
    plan = walked._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "zip_with(" not in plan and walked.columns == ["id", "x", "probability"]
    z = np.array([0.5, -1.0, 2.0])
    for k, (matrix, bias) in enumerate(model_walk.layer_weights(formula_weights(layers), layers)):
        z = matrix @ z + bias
        z = z if k == 2 else 1 / (1 + np.exp(-z))
    found = {r.id: r.probability for r in walked.collect()}
    assert found[1] == pytest.approx(np.exp(z) / np.exp(z).sum(), abs=1e-12) and found[2] == [None, None]


def test_given_weights_are_where_a_fit_starts(rows):
    layers = [3, 4, 2]
    start = formula_weights(layers)
    model = models.fit_perceptron(rows, NAMES, layers=layers, initial=start, iterations=0)
    assert model.weights.toArray().tolist() == start
    moved = models.fit_perceptron(rows, NAMES, layers=layers, initial=start, iterations=3)
    assert moved.weights.toArray().tolist() != start


def test_a_perceptron_is_trained_on_all_cores(spark, rows, monkeypatch):
    seen, fit = [], models.MultilayerPerceptronClassifier.fit
    monkeypatch.setattr(models.MultilayerPerceptronClassifier, "fit", lambda self, df: seen.append(df) or fit(self, df))
    models.fit_perceptron(rows.coalesce(1), NAMES, hidden=(4,), iterations=1)
    sizes = [r.n for r in seen[0].groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) < 2 * min(sizes) and sum(sizes) == 900
    models.fit_perceptron(rows.coalesce(1), NAMES, hidden=(4,), iterations=1, even=False)
    assert seen[1].rdd.getNumPartitions() == 1


def test_equal_rows_counted_give_the_same_forest(spark, rows):
    rough = rows.select("label", *[F.round(c, 1).alias(c) for c in NAMES])
    settings = {"trees": 3, "depth": 6, "subset": "all", "bootstrap": False}
    plain, counted = (models.fit_forest(rough, NAMES, count_equal=c, **settings) for c in (False, True))
    trees = [sorted((r.tree, r.node, r.feature, r.threshold or 0.0, *r.counts) for r in model_walk.node_table(spark, m).collect()) for m in (plain, counted)]
    assert trees[0] == trees[1] and len(trees[0]) > 20
    with pytest.raises(ValueError, match="draws rows"):
        models.fit_forest(rough, NAMES, count_equal=True)


def test_a_large_greedy_forest_counts_equal_rows(rows, monkeypatch):
    seen, fit = [], models.RandomForestClassifier.fit
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, df: seen.append(df) or fit(self, df))
    rough = rows.select("label", *[F.round(c, 1).alias(c) for c in NAMES])
    models.fit_large_forest(rough.repartition(16), NAMES, trees=2, depth=3, subset="all", bootstrap=False)
    assert seen[0].count() == rough.distinct().count() and seen[0].rdd.getNumPartitions() == 1


def test_a_large_greedy_forest_is_grown_and_held_in_groups(spark, rows, monkeypatch):
    """No more nodes at a time than the driver is to hold, and the same votes as of all trees at once."""
    seen, fit = [], models.RandomForestClassifier.fit
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, df: seen.append(self.getNumTrees()) or fit(self, df))
    rough = rows.select("label", *[F.round(c, 1).alias(c) for c in NAMES])
    monkeypatch.setattr(models, "HELD_NODES", 2 * rough.select(*NAMES).distinct().count() * 3)
    settings = {"trees": 7, "depth": 8, "bootstrap": False}
    forest = models.fit_large_forest(rough, NAMES, subset="all", **settings)
    assert seen == [3, 3, 1] and forest.getNumTrees == 7 and forest.times.tolist() == [7]
    plain = models.fit_forest(rough, NAMES, subset="all", **settings)
    held, whole = (models.score(m, rough.distinct(), NAMES).orderBy("label", *NAMES).collect() for m in (forest, plain))
    for a, b in zip(held, whole, strict=True):
        assert a.prediction == b.prediction and list(a.probability) == pytest.approx(list(b.probability), abs=1e-12)
        assert list(a.rawPrediction) == pytest.approx(list(b.rawPrediction), abs=1e-9)
    other = models.fit_large_forest(rough, NAMES, subset="sqrt", **settings)  # a node looks at some features only
    assert other.getNumTrees == 7 and len(other.times) > 3
