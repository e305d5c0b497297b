"""Boosted trees by Newton steps on binned sums, grown leaf by leaf.

A tree grows from its root; the leaf whose best split gains most is split next, until the tree has its
leaves. What a split needs are the sums of gradients and curvatures per feature and bin of the two new
leaves, so a tree of n leaves takes n - 1 passes over the binned rows, each with at most ``features * bins``
sums per leaf and task and one small table for the driver. Scores are worked out anew in every pass from the trees
so far, so no state is kept between passes and lost tasks are simply run again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import freeze

LEAST_GAIN = 1e-6


@dataclass
class Tree:
    """Splits in order: the rows of ``leaf`` whose bin of ``feature`` is above ``bin`` go to a new leaf,
    numbered by the splits so far. One weight per leaf."""

    splits: list[tuple[int, int, int]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), np.int64)
        for new, (leaf, feature, cut) in enumerate(self.splits, start=1):
            at[(at == leaf) & (bins[:, feature] > cut)] = new
        return at


@dataclass
class Boosted:
    """Cuts per feature (a value belongs to the bin of as many cuts as lie below it) and the trees."""

    features: tuple[str, ...]
    cuts: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        """The score after every round, one column per round, the first before any."""
        steps = [np.full(len(bins), self.base)]
        steps += [np.asarray(tree.weights)[tree.leaves(bins)] for tree in self.trees]
        return np.cumsum(np.column_stack(steps), 1)


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int, accuracy: int = 10_000) -> list[list[float]]:
    """Up to ``bins - 1`` cuts per feature at equal shares of the rows: values of the table, from one
    mergeable summary per feature. Ranks are off by at most one in ``accuracy``."""
    shares = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [sorted(set(row[f"q{i}"] or [])) for i in range(len(features))]


def binned(features: Sequence[str], cuts: Sequence[Sequence[float]]) -> Column:
    """The bins of a row; a NULL or NaN feature is an error."""

    def one(name: str, own: Sequence[float]) -> Column:
        x = F.col(name).cast("double")
        place = sum((F.when(x > cut, 1).otherwise(0) for cut in own), F.lit(0))
        missing = F.raise_error(F.lit(f"{name} has a missing value")).cast("int")
        return F.when(x.isNull() | F.isnan(x), missing).otherwise(place).cast("tinyint")

    return F.array(*[one(c, own) for c, own in zip(features, cuts, strict=True)])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


_SUMS = "leaf int, feature int, bin int, g double, h double"
_SUMS_SCHEMA = pa.schema([("leaf", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("g", pa.float64()), ("h", pa.float64())])


def _summed(model: Boosted, growing: Tree, wanted: tuple[int, ...], bins: int):
    """Task code: sums of gradient and curvature per wanted leaf, feature and bin, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(model.features)
        sums = np.zeros((2, len(wanted), width, bins))
        for batch in batches:
            own = _matrix(batch.column("b"), width)
            y, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "n"))
            p = 1.0 / (1.0 + np.exp(-model.margins(own)[:, -1]))
            leaf = growing.leaves(own)
            for k, number in enumerate(wanted):
                mine = leaf == number
                g, h = (n * (p - y))[mine], (n * p * (1.0 - p))[mine]
                for f in range(width):
                    sums[0, k, f] += np.bincount(own[mine, f], g, bins)
                    sums[1, k, f] += np.bincount(own[mine, f], h, bins)
        k, f, b = np.nonzero(sums[1])
        columns = [np.asarray(wanted, np.int32)[k], f, b, sums[0, k, f, b], sums[1, k, f, b]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _SUMS_SCHEMA, strict=True)], schema=_SUMS_SCHEMA)

    return run


def _sums(rows: DataFrame, model: Boosted, growing: Tree, wanted: tuple[int, ...], bins: int) -> dict[int, np.ndarray]:
    found = {leaf: np.zeros((2, len(model.features), bins)) for leaf in wanted}
    task = rows.mapInArrow(_summed(model, growing, wanted, bins), _SUMS)
    for leaf, f, b, g, h in task.groupBy("leaf", "feature", "bin").agg(F.sum("g"), F.sum("h")).collect():
        found[leaf][:, f, b] = g, h
    return found


def best_split(sums: np.ndarray, l2: float, min_curvature: float) -> tuple[float, int, int] | None:
    """Gain, feature and bin of the best split of a leaf; the first of equals, none without gain."""
    g, h = np.cumsum(sums[0], 1), np.cumsum(sums[1], 1)
    total_g, total_h = g[:, -1:], h[:, -1:]
    rest_g, rest_h = total_g - g, total_h - h
    gain = g**2 / (h + l2) + rest_g**2 / (rest_h + l2) - total_g**2 / (total_h + l2)
    gain[(h < min_curvature) | (rest_h < min_curvature)] = -np.inf
    f, b = np.unravel_index(gain.argmax(), gain.shape)
    return (float(gain[f, b]), int(f), int(b)) if gain[f, b] > LEAST_GAIN else None


def fit(
    df: DataFrame, features: Sequence[str], label: str = "label", rounds: int = 20, rate: float = 0.35,
    leaves: int = 4, depth: int = 6, bins: int = 8, min_curvature: float = 6.0, l2: float = 1.0,
    base: float = 0.5, grow: str = "best", accuracy: int = 10_000,
) -> Boosted:
    """Boosted trees for a 0/1 label with logistic loss; the settings are those of the job.

    A leaf may be split if both sides keep a curvature sum of ``min_curvature`` and lie at most ``depth``
    splits below the root. ``grow="best"`` splits the leaf that gains most next, ``"depth"`` the highest
    one. ``base`` is the probability before the first round. Rows are binned, equal ones counted, and
    stored once: with few features or few values the passes read far fewer rows than the table has.
    """
    if grow not in ("best", "depth"):
        raise ValueError("grow must be 'best' or 'depth'")
    names = tuple(features)
    model = Boosted(names, quantile_cuts(df, names, bins, accuracy), float(np.log(base / (1.0 - base))))
    rows = df.select(F.col(label).cast("double").alias("y"), binned(names, model.cuts).alias("b"))
    rows = freeze(rows.groupBy("y", "b").agg(F.count("*").alias("n")))
    for _ in range(rounds):
        tree = Tree()
        sums, level = _sums(rows, model, tree, (0,), bins), {0: 0}
        totals = {0: sums[0][:, 0].sum(1)}
        while len(tree.splits) + 1 < leaves:
            options = []
            for leaf, own in sums.items():
                split = best_split(own, l2, min_curvature) if level[leaf] < depth else None
                if split:
                    options.append((level[leaf] if grow == "depth" else 0, -split[0], leaf, split[1:]))
            if not options:
                break
            *_, leaf, (feature, cut) = min(options)
            tree.splits.append((leaf, feature, cut))
            new = len(tree.splits)
            level[leaf] += 1
            level[new] = level[leaf]
            low = sums[leaf][:, feature, : cut + 1].sum(1)
            totals[leaf], totals[new] = low, totals[leaf] - low
            if new + 1 < leaves:  # the last leaves are not split, their totals are known
                sums |= _sums(rows, model, tree, (leaf, new), bins)
        tree.weights = [float(-rate * g / (h + l2)) for _, (g, h) in sorted(totals.items())]
        model.trees.append(tree)
    return model


def _rounds(model: Boosted):
    @F.arrow_udf("array<double>")
    def scored(column: pa.Array) -> pa.Array:
        found = model.margins(_matrix(column, len(model.features)))
        ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

    return scored


def score(model: Boosted, df: DataFrame) -> DataFrame:
    """Add ``margin``, ``probability`` (of class 1) and ``prediction``."""
    margin = F.element_at(_rounds(model)(binned(model.features, model.cuts)), -1)
    scored = df.withColumn("margin", margin)
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
    return scored.withColumn("probability", probability).withColumn("prediction", (F.col("margin") > 0).cast("double"))


def curve(model: Boosted, df: DataFrame, label: str = "label", part: str = "part") -> DataFrame:
    """Per part and round (0: before any): rows, mean log-loss and accuracy, from one pass."""
    margins = _rounds(model)(binned(model.features, model.cuts))
    y = F.col(label).cast("double")
    rounds = df.select(F.col(part).alias("part"), y.alias("y"), F.posexplode(margins).alias("iteration", "m"))
    sign = F.when(F.col("y") == 1, F.col("m")).otherwise(-F.col("m"))
    loss = F.greatest(-sign, F.lit(0.0)) + F.log1p(F.exp(-F.abs(sign)))
    hit = ((F.col("m") > 0).cast("double") == F.col("y")).cast("double")
    return rounds.groupBy("part", "iteration").agg(F.count("*").alias("n_rows"), F.avg(loss).alias("log_loss"), F.avg(hit).alias("accuracy"))
