"""Trained models as tables and plain arithmetic, apart from the classes that trained them.

``node_table`` is a tree model as rows, ``Trees`` walks its flat node arrays over Arrow batches, and
``forward`` writes a perceptron as SQL expressions over columns, from its weight vector alone.
A model can so be stored, read, checked and applied where its class is not at hand.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path


def node_table(spark: SparkSession, model: Model, path: str | None = None) -> DataFrame:
    """One row per node: ``tree, node, feature, threshold, left, right, counts, rows, gain``.

    ``counts`` are the (weighted) class counts of the rows of a node, of which there are ``rows``; a leaf
    has feature, left and right -1, and no threshold. The model is stored under ``path``.
    """
    path = path or scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "treeID" not in data.columns:
        data = data.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    n = "nodeData"
    return data.select(
        F.col("treeID").alias("tree"),
        F.col(f"{n}.id").alias("node"),
        F.col(f"{n}.split.featureIndex").alias("feature"),
        F.get(f"{n}.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col(f"{n}.leftChild").alias("left"),
        F.col(f"{n}.rightChild").alias("right"),
        F.col(f"{n}.impurityStats").alias("counts"),
        F.col(f"{n}.rawCount").alias("rows"),
        F.col(f"{n}.gain").alias("gain"),
    )


@dataclass
class Trees:
    """All nodes of a forest in flat arrays; children are places in them, -1 below a leaf."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray

    @classmethod
    def read(cls, nodes: DataFrame) -> Trees:
        """The driver holds the whole model here, as it does wherever a forest is applied."""
        table = nodes.orderBy("tree", "node").toArrow().combine_chunks()
        tree, left, right = (table[c].to_numpy() for c in ("tree", "left", "right"))
        roots = np.flatnonzero(np.diff(tree, prepend=-1))
        start = roots[np.searchsorted(roots, np.arange(len(tree)), "right") - 1]
        counts = np.stack(table["counts"].to_numpy(zero_copy_only=False))
        threshold = table["threshold"].to_numpy(zero_copy_only=False).astype(np.float64)
        below = [np.where(side < 0, -1, start + side) for side in (left, right)]
        return cls(roots, table["feature"].to_numpy(), threshold, *below, counts)

    @classmethod
    def together(cls, parts: Sequence[Trees]) -> Trees:
        """The trees of all parts, in order."""
        starts = np.cumsum([0, *(len(t.feature) for t in parts)])
        moved = [[np.where(side < 0, -1, s + side) for side in (t.left, t.right)] for t, s in zip(parts, starts)]
        roots = np.concatenate([t.roots + s for t, s in zip(parts, starts)])
        feature, threshold, counts = (np.concatenate([getattr(t, c) for t in parts]) for c in ("feature", "threshold", "counts"))
        return cls(roots, feature, threshold, *map(np.concatenate, zip(*moved)), counts)

    def apart(self) -> Iterator[Trees]:
        """Every tree by itself."""
        for s, e in zip(self.roots, [*self.roots[1:], len(self.feature)]):
            below = [np.where(side[s:e] < 0, -1, side[s:e] - s) for side in (self.left, self.right)]
            yield Trees(np.zeros(1, np.int64), self.feature[s:e], self.threshold[s:e], *below, self.counts[s:e])

    def name(self) -> bytes:
        """The same for trees with the same nodes, splits and counts."""
        arrays = (self.roots, self.feature, self.threshold, self.left, self.right, self.counts)
        return sha256(b"".join(sha256(np.ascontiguousarray(a)).digest() for a in arrays)).digest()

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree."""
        at = np.repeat(self.roots[None, :], len(rows), 0)
        while True:
            inner = self.left[at] >= 0
            if not inner.any():
                return at
            row, tree = np.nonzero(inner)
            node = at[row, tree]
            goes_left = rows[row, self.feature[node]] <= self.threshold[node]
            at[row, tree] = np.where(goes_left, self.left[node], self.right[node])

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Mean over the trees of the class shares of the leaf."""
        shares = self.counts / self.counts.sum(1, keepdims=True)
        return shares[self.leaves(rows)].mean(1)

    def paths(self) -> list[dict]:
        """The nodes of the first tree by path: the root is 1, the children of i are 2i and 2i + 1."""
        found, waiting = [], [(1, int(self.roots[0]))]
        while waiting:
            path, at = waiting.pop()
            inner = self.left[at] >= 0
            found.append({
                "path": path, "feature": int(self.feature[at]), "threshold": float(self.threshold[at]) if inner else None,
                "counts": self.counts[at].tolist(),
            })
            if inner:
                waiting += [(2 * path, int(self.left[at])), (2 * path + 1, int(self.right[at]))]
        return sorted(found, key=lambda n: n["path"])


@dataclass
class Forest:
    """A forest apart from its class, in which equal trees stand once, with the number of ``times`` that they
    were grown. All of them have their say: a tree's shares count as often as it was grown."""

    trees: Trees
    times: np.ndarray

    @classmethod
    def of(cls, groups: Iterable[Trees]) -> Forest:
        """All trees of the groups, which are taken one at a time."""
        held, times = {}, {}
        for group in groups:
            for tree in group.apart():
                name = tree.name()
                held.setdefault(name, tree)
                times[name] = times.get(name, 0) + 1
        return cls(Trees.together(list(held.values())), np.array(list(times.values()), np.float64))

    @property
    def getNumTrees(self) -> int:
        return int(self.times.sum())

    def votes(self, rows: np.ndarray) -> np.ndarray:
        """Sum over all trees of the class shares of the leaf."""
        shares = self.trees.counts / self.trees.counts.sum(1, keepdims=True)
        return (shares[self.trees.leaves(rows)] * self.times[None, :, None]).sum(1)

    def transform(self, df: DataFrame, vector: str = "features") -> DataFrame:
        """Add ``rawPrediction``, ``probability`` and ``prediction`` as Spark's class does, to rows with their vector."""
        forest = self

        @F.arrow_udf("array<double>")
        def voted(vectors: pa.Array) -> pa.Array:
            if vectors.null_count:
                raise ValueError("a feature vector is NULL")
            if not len(vectors):
                return pa.array([], pa.list_(pa.float64()))
            rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
            found = np.concatenate([forest.votes(part) for part in np.array_split(rows, len(rows) // 4096 + 1)])
            ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

        raw, all_ = F.col("rawPrediction"), float(self.getNumTrees)
        added = df.withColumn("rawPrediction", voted(vector_to_array(F.col(vector))))
        added = added.withColumns({
            "probability": array_to_vector(F.transform(raw, lambda v: v / F.lit(all_))),
            "prediction": (F.array_position(raw, F.array_max(raw)) - 1).cast("double"),
        })
        return added.withColumn("rawPrediction", array_to_vector(raw))


def walk(df: DataFrame, trees: Trees, features: Sequence[str], to: str = "probability") -> DataFrame:
    """Add the class probabilities of a forest as an array; NULL features are an error."""

    @F.arrow_udf("array<double>")
    def scored(*columns: pa.Array) -> pa.Array:
        if any(c.null_count for c in columns):
            raise ValueError("a feature is NULL")
        rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns])
        found = np.concatenate([trees.probabilities(part) for part in np.array_split(rows, len(rows) // 4096 + 1)])
        ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

    return df.withColumn(to, scored(*[F.col(c).cast("double") for c in features]))


# -- perceptrons ----------------------------------------------------------------------------


def layer_weights(weights: Sequence[float], layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrix (outputs by inputs) and bias of every layer from a flat weight vector."""
    flat, found, at = np.asarray(weights, np.float64), [], 0
    if len(flat) != sum((i + 1) * o for i, o in zip(layers, layers[1:])):
        raise ValueError("the weights do not fit the layers")
    for i, o in zip(layers, layers[1:]):
        found.append((flat[at : at + i * o].reshape(i, o).T, flat[at + i * o : at + (i + 1) * o]))
        at += (i + 1) * o
    return found


def forward(layers: Sequence[int], weights: Sequence[float], inputs: Sequence[str]) -> list[list[str]]:
    """A perceptron as SQL expressions: for each layer one for each unit, over the names of the units before,
    ``inputs`` first and then those of ``unit_name``. Sigmoid layers, and sums at the end.

    Every unit is a column of its own and its sum is written out, which Spark compiles; functions over array
    elements are not compiled and take several times as long. Sums are written as even trees, or the plan would
    be as deep as a layer is wide.
    """

    def total(terms: list[str]) -> str:
        half = len(terms) // 2
        return f"({total(terms[:half])} + {total(terms[half:])})" if half else terms[0]

    found, before, stages = [], [f"`{c}`" for c in inputs], layer_weights(weights, layers)
    for k, (matrix, bias) in enumerate(stages):
        units = zip(matrix.tolist(), bias.tolist())
        sums = [total([*(f"{w!r}D * {x}" for w, x in zip(row, before)), f"{b!r}D"]) for row, b in units]
        found.append(sums if k == len(stages) - 1 else [f"1D / (1D + exp(-{z}))" for z in sums])
        before = [f"`{unit_name(k, i)}`" for i in range(len(sums))]
    return found


def unit_name(layer: int, unit: int) -> str:
    return f"unit {layer} {unit}"


def feed_forward(df: DataFrame, inputs: Column, weights: Sequence[float], layers: Sequence[int], to: str = "probability") -> DataFrame:
    """Add the class probabilities of a perceptron as an array, by built-in functions only; NULLs where an
    input is NULL. Whether all inputs are there is asked of an array in every step: Spark then compiles each
    step by itself, in many small methods, and the driver none. All steps as one method would be too long for it."""
    names = [f"unit in {i}" for i in range(layers[0])]
    given = [F.get(inputs, F.lit(i)).cast("double") for i in range(layers[0])]
    full = reduce(Column.__and__, [x.isNotNull() for x in given])
    held = df.withColumns({"unit full": full, **{c: F.coalesce(x, F.lit(float("nan"))) for c, x in zip(names, given)}})
    still = F.exists(F.array(F.col("unit full")), lambda x: x)
    old = names
    for k, units in enumerate(forward(layers, weights, names)):
        new = [unit_name(k, i) for i in range(len(units))]
        held = held.withColumns({"unit full": still, **{c: F.expr(z) for c, z in zip(new, units)}}).drop(*old)
        old = new
    z = [F.col(c) for c in old]
    held = held.withColumn("unit top", F.greatest(*z) if len(z) > 1 else z[0])
    held = held.withColumns({c: F.exp(x - F.col("unit top")) for c, x in zip(old, z)})
    held = held.withColumn("unit top", reduce(Column.__add__, z))
    shares = F.array(*[F.when(F.col("unit full"), x / F.col("unit top")) for x in z])
    return held.withColumn(to, shares).drop("unit full", "unit top", *old)
