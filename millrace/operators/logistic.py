"""Logistic regression by full-batch gradient descent.

One pass over the rows gives everything an iteration needs at the current weights: the gradient
sums, the loss and the confusion counts of the train and the test part. A pass is one aggregate
with map-side combine; only its single row of sums reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import (
    as_column,
    dot,
    dot_text,
    hard_class,
    logistic_loss,
    logistic_slope,
    signed_label,
)
from millrace.session import keep_spread

# More columns than this become one array, whose gradient tasks add up by matrix products. Whole-stage
# code generation ends at 100 fields (spark.sql.codegen.maxFields), and a pass adds up eleven numbers
# besides the gradient. Scores, losses, slopes and what counts as missing are the same columns either way.
WIDE = 80
COUNTS = ("tp", "fp", "tn", "fn")
INTERCEPT = "intercept"


# -- losses -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Loss:
    """A loss of the signed label y and the score z, with its derivative in z."""

    value: Callable[[Column, Column], Column]
    slope: Callable[[Column, Column], Column]


LOGISTIC = Loss(logistic_loss, logistic_slope)


# -- one pass -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Pass:
    """Sums over the rows at one weight vector, without regularisation."""

    loss: float
    gradient: np.ndarray
    train: dict[str, int]
    test: dict[str, int]
    unscored: int


@dataclass(frozen=True)
class Rows:
    """Rows ready for passes: signed label ``y``, flag ``is_train`` and the features.

    Few features are columns ``x1..xd``; many are one array column ``x``. What a pass derives from the
    score and adds up does not depend on the weights, so those expressions are built once.
    """

    df: DataFrame
    width: int
    wide: bool
    steps: Sequence[Column] = ()
    sums: dict[str, Column] = field(default_factory=dict)


def prepare_rows(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    is_train: Column | None = None,
    loss: Loss = LOGISTIC,
    wide: bool | None = None,
) -> Rows:
    """``features``: column names, or the name of one array column, as wide as its longest row; shorter
    rows count as rows with a missing feature. The label may be 0/1 or -1/+1.
    """
    y = signed_label(label).alias("y")
    flag = F.coalesce(F.lit(True) if is_train is None else is_train, F.lit(False)).alias("is_train")
    if isinstance(features, str):
        x = F.col(features).cast("array<double>")
        width = df.agg(F.max(F.size(features))).first()[0]
        return Rows(df.select(y, flag, x.alias("x")), max(width or 0, 0), True, *_steps(loss, ["x"]))
    columns = [F.col(c).cast("double") for c in features]
    if wide or (wide is None and len(columns) > WIDE):
        return Rows(df.select(y, flag, F.array(*columns).alias("x")), len(columns), True, *_steps(loss, ["x"]))
    names = [f"x{j}" for j in range(1, len(columns) + 1)]
    named = [c.alias(name) for c, name in zip(columns, names)]
    steps, sums = _steps(loss, names)
    for j, name in enumerate(["1", *names]):
        sums[f"g{j}"] = F.expr(f"sum(w * {name})").alias(f"g{j}")
    return Rows(df.select(y, flag, *named), len(columns), False, steps, sums)


def _steps(loss: Loss, names: Sequence[str]) -> tuple[list[Column], dict[str, Column]]:
    """What a pass derives from the score ``z`` of a row, and what it adds up besides the gradient.

    A row without a label or a whole score is counted as unscored and adds nothing else.
    """
    y, z, training, good = F.col("y"), F.col("z"), F.col("is_train"), F.col("good")
    whole = z.isNotNull() & ~F.isnan(z) & y.isNotNull()
    steps = [
        *[F.col(c) for c in ("y", "is_train", "z", *names)],
        whole.alias("good"),
        loss.value(y, z).alias("loss"),
        F.when(training & whole, loss.slope(y, z)).alias("w"),  # NULL where a row trains nothing
    ]
    among = training & good
    sums = {"loss": F.sum(F.when(among, F.col("loss")))}
    for part, own in (("train", among), ("test", ~training & good)):
        for cell, hit in _cells(y, z).items():
            sums[f"{part}_{cell}"] = F.count_if(own & hit)
    sums["unscored"] = F.count_if(~good)
    return steps, {name: value.alias(name) for name, value in sums.items()}


def run_pass(rows: Rows, beta: Sequence[float]) -> Pass:
    beta = [float(b) for b in beta]
    if len(beta) != rows.width + 1:
        raise ValueError(f"{len(beta)} weights for {rows.width} features and a bias")
    sums = _wide_sums(rows, beta) if rows.wide else _narrow_sums(rows, beta)
    counted = {name: {c: int(sums[f"{name}_{c}"]) for c in COUNTS} for name in ("train", "test")}
    return Pass(
        loss=sums["loss"],
        gradient=np.array([sums[f"g{j}"] for j in range(rows.width + 1)]),
        train=counted["train"],
        test=counted["test"],
        unscored=int(sums["unscored"]),
    )


def _narrow_sums(rows: Rows, beta: list[float]) -> dict[str, float]:
    z = F.expr(dot_text(beta, [f"x{j}" for j in range(1, rows.width + 1)])).alias("z")
    row = rows.df.select("*", z).select(*rows.steps).agg(*rows.sums.values()).first()
    return {name: row[name] or 0.0 for name in rows.sums}


def _cells(y: Column, z: Column) -> dict[str, Column]:
    """A score of exactly 0 falls into no cell."""
    return {
        "tp": (z > 0) & (y == 1),
        "fp": (z > 0) & (y == -1),
        "tn": (z < 0) & (y == -1),
        "fn": (z < 0) & (y == 1),
    }


def _wide_sums(rows: Rows, beta: list[float]) -> dict[str, float]:
    """The score is a fold over the array. Tasks add up slopes times rows per Arrow batch; what else a
    pass adds up travels as one array of numbers per row."""
    width = rows.width
    bias, *weights = [f"{b!r}D" if math.isfinite(b) else f"double('{b}')" for b in beta]
    products = f"zip_with(x, array({', '.join(weights)}), (a, b) -> a * b)" if weights else "array()"
    fold = F.expr(f"aggregate({products}, {bias}, (s, v) -> s + v)")
    z = F.when(F.size("x") == width, fold).alias("z")
    scored = rows.df.select("*", z).select(*rows.steps)
    good, train = F.col("good"), F.col("is_train")
    flags = {"loss": F.when(good & train, F.col("loss")).otherwise(0.0), "unscored": (~good).cast("double")}
    for part, own in (("train", train & good), ("test", ~train & good)):
        for cell, hit in _cells(F.col("y"), F.col("z")).items():
            flags[f"{part}_{cell}"] = F.coalesce(own & hit, F.lit(False)).cast("double")
    names, n = [*flags, *[f"g{j}" for j in range(width + 1)]], len(flags)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names))
        for batch in batches:
            total[:n] += [pc.sum(c).as_py() or 0.0 for c in batch.columns[2:]]
            some = batch.filter(batch.column(0).is_valid())
            slope = some.column(0).to_numpy(zero_copy_only=False)
            x = some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if width else np.zeros((len(slope), 0))
            total[n:] += [slope.sum(), *(slope @ x)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(names), dtype="int32")), pa.array(total)], names=["slot", "value"]
        )

    added = scored.select("w", "x", *[c.alias(n) for n, c in flags.items()]).mapInArrow(sums, "slot int, value double")
    return {names[row["slot"]]: row["value"] for row in added.groupBy("slot").agg(F.sum("value").alias("value")).collect()}


# -- sums as tables -----------------------------------------------------------------------


def total_loss(rows: Rows, beta: Sequence[float], lam: float = 0.0) -> float:
    """Sum of the losses over the train rows plus ``lam * |beta|^2``."""
    return _checked(run_pass(rows, beta)).loss + lam * float(np.dot(beta, beta))


def total_gradient(rows: Rows, beta: Sequence[float], lam: float = 0.0) -> np.ndarray:
    """Sum of the gradients over the train rows plus ``2 * lam * beta``; bias first."""
    return _checked(run_pass(rows, beta)).gradient + 2.0 * lam * np.asarray(beta, dtype="float64")


def vector_frame(spark: SparkSession, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    """Position, term and value; the bias comes first as ``intercept``."""
    terms = [INTERCEPT, *names]
    rows = [(i, t, float(v)) for i, (t, v) in enumerate(zip(terms, values, strict=True))]
    return spark.createDataFrame(rows, "position int, term string, value double")


# -- scoring and smoothed metrics -----------------------------------------------------------


def score(
    df: DataFrame, features: Sequence[str], beta: Sequence[float], output: str = "score"
) -> DataFrame:
    """Add the score and its sign as ``prediction``. A projection; works on streams too."""
    return df.withColumn(output, dot(beta, features)).withColumn("prediction", hard_class(output))


def confusion(df: DataFrame, label: str, score_column: str = "score", part: str | None = None) -> DataFrame:
    """P, N, TP, FP, TN, FN with every cell one higher than counted; P and N are predictions."""
    cells = _cells(signed_label(label), as_column(score_column))
    sums = [F.count_if(hit).alias(name) for name, hit in cells.items()]
    counted = (df.groupBy(part) if part else df).agg(*sums)
    one = {c: F.col(c).cast("double") + 1.0 for c in COUNTS}
    return counted.select(
        *([part] if part else []),
        (one["tp"] + one["fp"]).alias("p"),
        (one["tn"] + one["fn"]).alias("n"),
        *[one[c].alias(c) for c in COUNTS],
    )


def smoothed_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision and recall of ``confusion`` rows."""
    kept = [c for c in counts.columns if c not in ("p", "n", *COUNTS)]
    tp, fp, tn, fn = (F.col(c) for c in COUNTS)
    return counts.select(
        *kept,
        ((tp + tn) / (F.col("p") + F.col("n"))).alias("accuracy"),
        (tp / (tp + fp)).alias("precision"),
        (tp / (tp + fn)).alias("recall"),
    )


def _rates(counts: dict[str, int]) -> tuple[float, float, float]:
    tp, fp, tn, fn = (counts[c] + 1 for c in COUNTS)
    return (tp + tn) / (tp + fp + tn + fn), tp / (tp + fp), tp / (tp + fn)


# -- training -----------------------------------------------------------------------------

HISTORY = (
    "iteration int, loss double, grad_norm double, alpha double, "
    "train_accuracy double, train_precision double, train_recall double, "
    "test_accuracy double, test_precision double, test_recall double"
)


@dataclass
class Fit:
    """Weights (bias first) and one history row per update."""

    features: list[str]
    beta: list[float]
    eps: float
    history: list[tuple] = field(default_factory=list)

    @property
    def iterations(self) -> int:
        """Number of the iteration that was not begun any more: updates done plus one."""
        return len(self.history) + 1

    @property
    def converged(self) -> bool:
        """Whether the last gradient norm was below ``eps``; never without an update."""
        return bool(self.history) and self.history[-1][2] < self.eps

    def history_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY)

    def coefficients_frame(self, spark: SparkSession) -> DataFrame:
        return vector_frame(spark, self.features, self.beta)


def train(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    is_train: Column | None = None,
    lam: float = 1.0,
    eps: float = 1e-3,
    max_iter: int = 1000,
    alpha: float = 1e-7,
    loss: Loss = LOGISTIC,
    beta: Sequence[float] | None = None,
    wide: bool | None = None,
    cache: bool = True,
) -> Fit:
    """At most ``max_iter - 1`` updates ``beta -= alpha * gradient`` from zero weights.

    Gradient and norm belong to the weights before an update, loss and metrics to those after
    it. Descent ends when the norm is at most ``eps`` (``eps = 0`` does no update). Weights that leave
    the range of numbers are an error. The n + 1
    passes of n updates read the same rows: only label, flag and features are kept, in memory
    and on executor disks; ``cache=False`` reads the input each time.
    """
    rows = prepare_rows(df, features, label, is_train, loss, wide)
    names = [f"{features}[{j}]" for j in range(rows.width)] if isinstance(features, str) else list(features)
    weights = np.zeros(rows.width + 1) if beta is None else np.array(beta, dtype="float64")
    history: list[tuple] = []
    kept = replace(rows, df=keep_spread(rows.df)) if cache else rows
    try:
        state = _checked(run_pass(kept, weights)) if eps > 0 and max_iter > 1 else None
        for update in range(1, max_iter if state else 1):
            slope = state.gradient + 2.0 * lam * weights
            weights = weights - alpha * slope
            length = math.sqrt(float(slope @ slope))
            state = _finite(run_pass(kept, weights), update)
            penalised = state.loss + lam * float(weights @ weights)
            history.append((update, penalised, length, float(alpha), *_rates(state.train), *_rates(state.test)))
            if not length > eps:
                break
    finally:
        if cache:
            kept.df.unpersist()
    return Fit(names, [float(w) for w in weights], eps, history)


def _checked(state: Pass) -> Pass:
    if state.unscored:
        raise ValueError(f"{state.unscored} rows have a missing label or feature")
    return state


def _finite(state: Pass, update: int) -> Pass:
    """Later passes read the same rows, so what has no score now had one before."""
    if state.unscored or not (math.isfinite(state.loss) and np.isfinite(state.gradient).all()):
        raise ValueError(f"the weights diverged at update {update}: take a smaller step")
    return state
