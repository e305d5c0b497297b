"""Tree ensembles and perceptrons: Spark's own distributed learners with the settings of the jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import model_walk
from millrace.operators.prepare import assemble
from millrace.session import keep, set_checkpoint_folder, spread

VECTOR = "features"
WEIGHT = "equal rows"  # column of their number
COUNTED_ROWS = 10_000  # least counted rows of a partition that a forest is grown over
HELD_NODES = 1_000_000  # most nodes of trees that the driver grows at a time, about 400 bytes each; one tree at least


def vectors(df: DataFrame, features: Sequence[str] | str, missing: str = "error") -> DataFrame:
    """Add the feature vector, from columns or from one array column."""
    if isinstance(features, str):
        return df.withColumn(VECTOR, array_to_vector(F.col(features).cast("array<double>")))
    return assemble(df, features, VECTOR, missing)


def _training(df: DataFrame, features: Sequence[str] | str, label: str, *others: str) -> DataFrame:
    """Only label and vector, so that nothing else is shuffled or kept by the learner."""
    return vectors(df, features).select(F.col(label).cast("double").alias(label), VECTOR, *others)


def _counted(df: DataFrame, features: Sequence[str] | str, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows equal in label and features as one with their number as WEIGHT: kept, and dealt out.

    They are dealt by their values and sorted, so that the layout depends on nothing else, over as many
    partitions as before, fewer if those would get less than COUNTED_ROWS: each partition holds sums of
    every node, however few its rows.
    """
    by = [label, *dict.fromkeys([features] if isinstance(features, str) else features)]
    counted = keep(df.groupBy(*by).agg(F.count("*").cast("double").alias(WEIGHT)))
    parts = max(1, min(df.rdd.getNumPartitions(), counted.count() // COUNTED_ROWS))
    return counted, counted.repartition(parts, *by).sortWithinPartitions(*by)


def _forest_learner(
    label: str, trees: int, depth: int, bins: int, subset: str, seed: int, node_memory_mb: int, keep_node_ids: bool,
    bootstrap: bool,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, featuresCol=VECTOR, numTrees=trees, maxDepth=depth, maxBins=bins,
        featureSubsetStrategy=subset, impurity="gini", seed=seed, maxMemoryInMB=node_memory_mb,
        cacheNodeIds=keep_node_ids, bootstrap=bootstrap,
    )


def fit_forest(
    df: DataFrame, features: Sequence[str] | str, label: str = "label", trees: int = 20,
    depth: int = 4, bins: int = 32, subset: str = "auto", seed: int = 1,
    node_memory_mb: int = 256, keep_node_ids: bool = False, bootstrap: bool = True, count_equal: bool = False,
) -> Model:
    """Random forest, gini impurity, all features continuous.

    Without ``bootstrap`` and with ``subset="all"`` every tree is the greedy tree of the table, which
    depends on nothing else. As many nodes as fit into ``node_memory_mb`` are split per pass over the rows. Kept node ids
    save walking each row down deep trees in every pass. ``count_equal`` gives equal rows to the learner
    as one with their number as weight: every node sums the same counts over fewer rows. Trees that draw
    rows need each of them, so it asks for no ``bootstrap``; a node's ``rows`` are then its distinct ones.
    """
    if keep_node_ids:
        set_checkpoint_folder(df.sparkSession)
    if count_equal and bootstrap:
        raise ValueError("a forest that draws rows cannot count equal ones")
    learner = _forest_learner(label, trees, depth, bins, subset, seed, node_memory_mb, keep_node_ids, bootstrap)
    if not count_equal:
        return learner.fit(_training(df, features, label))
    kept, rows = _counted(df, features, label)
    try:
        return learner.setWeightCol(WEIGHT).fit(_training(rows, features, label, WEIGHT))
    finally:
        kept.unpersist()


def fit_large_forest(
    df: DataFrame, features: Sequence[str] | str, label: str = "label", trees: int = 100,
    depth: int = 30, seed: int = 1, subset: str = "sqrt", bootstrap: bool = True,
) -> Model | model_walk.Forest:
    """A forest of 100 trees without a depth limit of its own; 30 is the deepest that Spark grows.

    Without ``bootstrap`` equal rows are counted, and the trees are grown in groups of at most HELD_NODES
    nodes, of which a tree has two for each distinct row of features at most; the driver keeps each group as flat
    arrays, in which equal trees stand once with their number, and not as Spark's objects. Every group has a seed of its own.
    """
    settings = {"bins": 32, "subset": subset, "node_memory_mb": 1024, "keep_node_ids": True, "bootstrap": bootstrap}
    if bootstrap:
        return fit_forest(df, features, label, trees, depth, seed=seed, **settings)
    spark = df.sparkSession
    set_checkpoint_folder(spark)
    kept, rows = _counted(df, features, label)
    training = _training(rows, features, label, WEIGHT)
    leaves = kept.drop(label, WEIGHT).distinct().count()
    most = max(1, HELD_NODES // (2 * max(1, leaves)))

    def grown():
        for start in range(0, trees, most):
            learner = _forest_learner(label, min(most, trees - start), depth, seed=seed + start, **settings)
            yield model_walk.Trees.read(model_walk.node_table(spark, learner.setWeightCol(WEIGHT).fit(training)))

    try:
        return model_walk.Forest.of(grown())
    finally:
        kept.unpersist()


def fit_boosted(
    df: DataFrame, features: Sequence[str] | str, label: str = "label", rounds: int = 20,
    rate: float = 0.35, depth: int = 2, bins: int = 8, min_rows: int = 24, seed: int = 27,
) -> Model:
    """Spark's own boosted trees, grown level by level: depth 2 gives four leaves, 24 rows carry at most a
    curvature sum of 6. ``boosting.fit`` takes leaves and curvature as such."""
    set_checkpoint_folder(df.sparkSession)
    learner = GBTClassifier(
        labelCol=label, featuresCol=VECTOR, maxIter=rounds, stepSize=rate, maxDepth=depth,
        maxBins=bins, minInstancesPerNode=min_rows, seed=seed,
    )
    return learner.fit(_training(df, features, label))


def fit_perceptron(
    df: DataFrame, features: Sequence[str] | str, label: str = "label",
    hidden: Sequence[int] = (64, 64), inputs: int | None = None, outputs: int = 2,
    layers: Sequence[int] | None = None, iterations: int = 5, seed: int = 1, block_rows: int = 128,
    initial: Sequence[float] | None = None, even: bool = True,
) -> Model:
    """Perceptron with sigmoid hidden layers and a soft-max output.

    ``layers`` overrides all widths; a wider output than there are classes is allowed. ``initial`` are
    the weights to start from, such as those of an earlier fit; else they are drawn by the seed. Every
    step passes over all rows, which are dealt out evenly over all cores first; not ``even`` leaves the layout.
    """
    if layers is None:
        width = inputs if isinstance(features, str) else len(features)
        if width is None:
            raise ValueError("an array column needs inputs=")
        layers = [width, *hidden, outputs]
    learner = MultilayerPerceptronClassifier(
        labelCol=label, featuresCol=VECTOR, layers=list(layers), maxIter=iterations, seed=seed,
        blockSize=block_rows,
    )
    if initial is not None:
        learner.setInitialWeights(Vectors.dense(list(initial)))
    rows = _training(df, features, label)
    return learner.fit(spread(rows) if even and iterations > 0 else rows)


def score(model: Model, df: DataFrame, features: Sequence[str] | str) -> DataFrame:
    """Add the vector and the model's ``prediction`` and ``probability``. A projection."""
    return model.transform(vectors(df, features))


def training_curve(model: Model, spark: SparkSession) -> DataFrame:
    """Training loss of a freshly fitted perceptron, one row per iteration."""
    losses = [(i, float(loss)) for i, loss in enumerate(model.summary().objectiveHistory)]
    return spark.createDataFrame(losses, "iteration int, loss double")


def boosting_curve(model: Model, df: DataFrame, features: Sequence[str] | str, label: str = "label") -> DataFrame:
    """Mean loss of Spark's boosted trees on a table, one row per number of rounds."""
    losses = model.evaluateEachIteration(_training(df, features, label))
    rows = [(i, float(loss)) for i, loss in enumerate(losses, start=1)]
    return df.sparkSession.createDataFrame(rows, "iteration int, loss double")
